"""Named look-back ranges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Months back per range name; YTD starts at the turn of the year, All and Max have no lower bound.
MONTHS_BACK = {"3M": 3, "6M": 6, "1Y": 12, "3Y": 36, "5Y": 60, "10Y": 120}
NAMES = ("3M", "6M", "YTD", "1Y", "3Y", "5Y", "10Y", "All")
STRATEGY_NAMES = ("YTD", "1Y", "3Y")
PORTFOLIO_NAMES = ("YTD", "1Y", "3Y", "5Y", "Max")


def start_of(name: str, anchor: Column, first: Column) -> Column:
    """First day of a range that ends at ``anchor``; ``first`` is the start of the open ranges."""
    if name in ("All", "Max"):
        return first
    if name == "YTD":
        return F.trunc(anchor, "year")
    return F.add_months(anchor, -MONTHS_BACK[name])


def bounds(
    df: DataFrame, names: Sequence[str] = NAMES, keys: Sequence[str] = ("ticker",), order: str = "date", as_of: date | None = None
) -> DataFrame:
    """(keys, timeframe, start_date, end_date), anchored at each series' newest day, or at ``as_of``."""
    edges = df.groupBy(*keys).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    anchor = F.col("_last") if as_of is None else F.lit(as_of)
    ranges = F.array(*[F.struct(F.lit(n).alias("timeframe"), start_of(n, anchor, F.col("_first")).alias("start_date")) for n in names])
    return edges.select(*keys, F.inline(ranges), F.col("_last").alias("end_date"))


def fan_out(
    df: DataFrame, names: Sequence[str] = STRATEGY_NAMES, keys: Sequence[str] = ("ticker",), order: str = "date", as_of: date | None = None
) -> DataFrame:
    """Each row once per range it falls into, with ``timeframe`` and ``start_date``."""
    edges = df.groupBy(*keys).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    anchor = F.col("_last") if as_of is None else F.lit(as_of)
    ranges = F.array(*[F.struct(F.lit(n).alias("timeframe"), start_of(n, anchor, F.col("_first")).alias("start_date")) for n in names])
    hit = F.filter(ranges, lambda r: F.col(order) >= r["start_date"])
    return df.join(edges, list(keys)).select(*df.columns, F.inline(hit))
