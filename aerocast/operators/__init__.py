"""DataFrame-level building blocks."""
