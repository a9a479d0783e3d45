"""Recomputation of the newest complete day, or of the whole history."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.resume import advance
from barloom.operators.signals import BATCH_ROWS, HOLD, batch_rule


def latest_bar(bars: DataFrame, as_of: date, lookback_days: int | None = None) -> DataFrame:
    """Indicators and signals of each ticker's last day before ``as_of``, whose own bar may be incomplete and is left out.

    Exponential means take the whole history, unless ``lookback_days`` cuts it: then they start inside the cut and differ from a full run by the weight of
    what is older. To avoid reading the history, keep state and use :func:`newest_bar`.
    """
    recent = bars.filter(F.col("date") < F.lit(as_of))
    if lookback_days is not None:
        recent = recent.filter(F.col("date") >= F.lit(as_of - timedelta(days=lookback_days)))
    newest = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    return batch_rule(recent).withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def newest_bar(bars: DataFrame, stored: DataFrame, as_of: date) -> DataFrame:
    """As :func:`latest_bar` over the whole history, from the state in ``stored`` and the last few bars; the new rows hold state too."""
    complete = bars.filter(F.col("date") < F.lit(as_of))
    since = complete.groupBy("ticker").agg(F.max("date").alias("_from"))
    return advance(complete, stored, since, lambda df: batch_rule(df, keep_state=True), BATCH_ROWS, HOLD)


def backfill(bars: DataFrame, start: date | None = None, keep_state: bool = False) -> DataFrame:
    """Indicators and signals of every day from ``start`` on."""
    return batch_rule(bars if start is None else bars.filter(F.col("date") >= F.lit(start)), keep_state=keep_state)
