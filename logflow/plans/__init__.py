"""Reusable plan shapes: skew-safe ordered scans and size-checked joins."""
