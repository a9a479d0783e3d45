"""Cleaning, profiles and table rules. A check returns the rows that break its rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.numbers import to_bool
from barloom.operators.dedupe import top_per_key

PRICE_COLUMNS = ("open", "high", "low", "close")
# Numeric columns of a stored price row.
NUMERIC_COLUMNS = (
    *PRICE_COLUMNS,
    "volume",
    "bb_sma_20",
    "bb_upper_20",
    "bb_lower_20",
    "rsi_14",
    "macd",
    "macd_signal",
    "macd_hist",
)
SIGNAL_COLUMNS = ("buy_signal", "sell_signal")


def clean_prices(df: DataFrame) -> DataFrame:
    """Typed price rows: unreadable dates dropped, unreadable numbers null, signals boolean (false when missing), rows without all four prices dropped."""
    present = set(df.columns)
    out = df.withColumn("date", F.to_date(F.try_to_timestamp(F.col("date").cast("string"))))
    out = out.withColumns({c: F.expr(f"try_cast(`{c}` as double)") for c in NUMERIC_COLUMNS if c in present})
    out = out.withColumns({c: to_bool(F.col(c)) if c in present else F.lit(False) for c in SIGNAL_COLUMNS})
    prices = list(PRICE_COLUMNS) if present.issuperset(PRICE_COLUMNS) else []
    return out.dropna(subset=["date", *prices])


def profile_prices(df: DataFrame) -> DataFrame:
    """Bars, first and last day per ticker and year."""
    return df.groupBy("ticker", F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def newest(df: DataFrame, n: int, keys: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """The newest ``n`` rows of each key."""
    return top_per_key(df, keys, n, F.col(order).desc())


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Keys containing null never conflict."""
    whole = df.dropna(subset=list(keys))
    return whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def check_domain(df: DataFrame, column: str, allowed: Sequence[str] | None = None, minimum: float | None = None) -> DataFrame:
    """Rows whose value is outside the list or under the minimum. Null passes."""
    bad = F.lit(False)
    if allowed is not None:
        bad = bad | ~F.col(column).isin(*allowed)
    if minimum is not None:
        bad = bad | (F.col(column) < minimum)
    return df.filter(bad)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.filter(bad)


def check_reference(df: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Rows that point to a parent that does not exist. Null points nowhere and passes."""
    known = parent.select(F.col(parent_column).alias(column))
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
