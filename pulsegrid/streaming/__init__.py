"""Incremental loading and streaming aggregation."""
