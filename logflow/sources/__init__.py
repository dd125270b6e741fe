"""logflow sources."""
