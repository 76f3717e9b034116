"""Readers: explicit schemas, permissive parsing, bad rows kept for quarantine."""
