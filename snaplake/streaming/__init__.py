"""Incremental loading, late updates and backfill."""
