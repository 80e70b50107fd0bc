"""Feed readers and table sinks."""
