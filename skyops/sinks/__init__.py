"""Writers: upsert, run audit, exports, alert and log encodings."""
