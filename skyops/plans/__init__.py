"""End-to-end compositions of sources, operators and sinks."""
