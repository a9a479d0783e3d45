"""The price table: bars with indicators and held signals in the stored layout."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import incremental
from barloom.operators.merge import upsert
from barloom.sources.tables import conform, stage

# Columns of the stored price table.
SCHEMA = T.StructType(
    [T.StructField("ticker", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")]
    + [T.StructField("volume", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("bb_sma_20", "bb_upper_20", "bb_lower_20", "rsi_14", "macd", "macd_signal", "macd_hist")
    ]
    + [T.StructField(c, T.BooleanType()) for c in ("buy_signal", "sell_signal")]
)
STORED = {"bb_mid": "bb_sma_20", "bb_upper": "bb_upper_20", "bb_lower": "bb_lower_20", "rsi": "rsi_14"}


#: Columns that let the next update go on from a row, at full precision: rows before it and its exponential means.
STATE = {"state_n": "long", "state_fast": "double", "state_slow": "double", "state_macd_signal": "double"}


def stored(df: DataFrame, digits: int | None = 4, state: bool = False) -> DataFrame:
    """The columns of the table, with ``state`` also those of :data:`STATE`."""
    named = df.withColumnsRenamed(STORED)
    if not state:
        return conform(named, SCHEMA, {"volume": F.lit(0)}, digits)
    whole = T.StructType([*SCHEMA.fields, *[T.StructField(n, {'long': T.LongType(), 'double': T.DoubleType()}[t]) for n, t in STATE.items()]])
    out = conform(named, whole, {"volume": F.lit(0)})
    if digits is None:
        return out
    return out.withColumns({f.name: F.bround(f.name, digits) for f in SCHEMA.fields if isinstance(f.dataType, T.DoubleType)})


def build(bars: DataFrame, start: date | None = None, digits: int | None = 4, state: bool = False) -> DataFrame:
    """All days from ``start`` on."""
    return stored(incremental.backfill(bars, start, state), digits, state)


def update(table: DataFrame, bars: DataFrame, as_of: date, lookback_days: int | None = None, digits: int | None = 4) -> DataFrame:
    """The table with each ticker's newest complete day recomputed.

    A table with state goes on from it and reads the last few bars; the new row equals that of a rebuild. Only the new rows are staged, so several updates may follow
    each other before the table is written. Without state, or with ``lookback_days``, the row comes from the history.
    """
    if lookback_days is None and set(STATE) <= set(table.columns):
        newest = stage(stored(incremental.newest_bar(bars, table, as_of), digits, True), "newest-rows")
        return upsert(table, newest, ["ticker", "date"])
    return upsert(table, stored(incremental.latest_bar(bars, as_of, lookback_days), digits), ["ticker", "date"])
