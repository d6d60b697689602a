"""Cleansing, purging, banding, pairing and consolidating record files as Spark tables."""
