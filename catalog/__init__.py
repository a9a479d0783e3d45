"""Registered queries: each Spark query next to the SQL that checks it."""

import importlib

# in the order the README lists them
MODULES = ("market", "strategy", "portfolio", "news", "records", "streams")


def load():
    """Import every module of queries and return the register."""
    from catalog import registry

    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return registry
