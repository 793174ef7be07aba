"""End-to-end jobs composed of sources, operators and sinks."""
