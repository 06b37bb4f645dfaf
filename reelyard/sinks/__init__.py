"""Writes: bronze/silver/guarded sinks and versioned snapshots."""
