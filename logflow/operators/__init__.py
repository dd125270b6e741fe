"""logflow operators."""
