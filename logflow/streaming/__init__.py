"""Structured Streaming forms: the collector (T2), the registry fold (T1),
claim liveness and per-tick counts (T3, A2)."""
