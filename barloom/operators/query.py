"""Keyed lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among ``wanted``; the batch form of a point query, and of a long IN list."""
    return df.join(wanted.select(*keys), list(keys), "left_semi")
