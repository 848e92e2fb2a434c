"""Registered queries over the given tables, each with its SQL counterpart where one exists."""

from importlib import import_module

MODULES = ("scalars", "filters", "groups", "joins", "spatial", "maintenance", "quality", "files", "learning", "streams")


def load():
    """(queries, oracles) of all modules."""
    for name in MODULES:
        import_module(f"suite.{name}")
    from suite.base import ORACLES, QUERIES

    return QUERIES, ORACLES
