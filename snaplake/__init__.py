"""Snapshot analytics on Spark: DataFrame functions for daily shop, product,
creator and content snapshots."""
