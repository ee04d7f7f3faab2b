"""Scans: reference files, raw API batches, landing zone, date spines."""
