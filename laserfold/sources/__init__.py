"""Point sources and table sinks."""
