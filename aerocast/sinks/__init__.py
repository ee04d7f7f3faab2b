"""Writes: raw loads with lineage, keyed appends, layered and versioned tables."""
