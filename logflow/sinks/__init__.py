"""logflow sinks."""
