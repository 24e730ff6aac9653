"""Registered queries with their SQL counterparts."""

from importlib import import_module

from pulsegrid.catalog.registry import QUERIES, SQL

FAMILIES = ("rows", "streams", "scores", "stores", "raw", "models", "live")


def load_all():
    """All queries and all SQL texts, by name."""
    for family in FAMILIES:
        import_module(f"pulsegrid.catalog.{family}")
    return QUERIES, SQL
