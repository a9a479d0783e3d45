"""Daily bars from a stream of ticks, and sessions of activity.

``daily_bars`` and ``sessions`` emit what is closed, once, and drop what comes later than the lateness. The partial forms keep every row:
micro-batches store partial bars and sessions, and the merge gives all days and sessions, the open ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.blocks import peak, running, total
from barloom.sources.tables import stage


def daily_bars(ticks: DataFrame, lateness: str = "1 day", order: str = "seq") -> DataFrame:
    """One bar per ticker and day (``ts``, ``ticker``, ``price``, ``quantity``), emitted once the day is closed for late ticks.

    Open and close follow (ts, ``order``). Partial bars are combined before the shuffle, so a busy ticker costs no more than any other.
    """
    at = F.struct("ts", order)
    bars = (
        ticks.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("day"), "ticker")
        .agg(
            F.min_by("price", at).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", at).alias("close"),
            F.sum("quantity").alias("volume"),
        )
    )
    return bars.select("ticker", F.to_date("day.start").alias("date"), "open", "high", "low", "close", "volume")


def sessions(events: DataFrame, key: str, gap: str, lateness: str = "1 day") -> DataFrame:
    """Runs of events of a key no further apart than ``gap``: the streaming form of signal clusters."""
    found = (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy(F.session_window("ts", gap).alias("session"), key)
        .agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )
    return found.select(key, "first_ts", "last_ts", "events")


def partial_bars(ticks: DataFrame, order: str = "seq") -> DataFrame:
    """What a micro-batch knows of each ticker and day."""
    at = F.struct(F.col("ts").cast("timestamp").alias("ts"), F.col(order).alias("seq"), "price")
    return ticks.groupBy("ticker", F.to_date("ts").alias("date")).agg(
        F.min(at).alias("first"), F.max("price").alias("high"), F.min("price").alias("low"), F.max(at).alias("last"), F.sum("quantity").alias("volume")
    )


def merged_bars(partials: DataFrame) -> DataFrame:
    """The bars of all ticks so far."""
    bars = partials.groupBy("ticker", "date").agg(
        F.min("first").alias("first"), F.max("high").alias("high"), F.min("low").alias("low"), F.max("last").alias("last"), F.sum("volume").alias("volume")
    )
    return bars.select("ticker", "date", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume")


def _slot(ts: Column, gap: str) -> Column:
    """Number of a stretch of time as long as the gap: events of one stretch are always of one session."""
    width = F.expr(f"unix_micros(timestamp '1970-01-01 00:00:00Z' + interval {gap})")
    return F.floor(F.unix_micros(ts) / width)


def partial_sessions(events: DataFrame, key: str, gap: str) -> DataFrame:
    """What a micro-batch knows of each key and stretch of time: an aggregate that combines before the shuffle, so a busy key is spread."""
    at = F.col("ts").cast("timestamp")
    found = events.withColumn("ts", at).filter("ts is not null").groupBy(key, _slot(F.col("ts"), gap).alias("slot"))
    return found.agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def combined_sessions(partials: DataFrame, key: str) -> DataFrame:
    """The partial rows of several micro-batches as those of one."""
    return partials.groupBy(key, "slot").agg(F.sum("events").alias("events"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def merged_sessions(partials: DataFrame, key: str, gap: str) -> DataFrame:
    """Sessions of all events so far: rows whose first event is no further than ``gap`` from the last one before are one session.

    How far events reach is a running peak, and sessions are numbered by a running count, both as scans inside (key, chunk of a thousand stretches) and over one row per
    chunk, so no task holds a key.
    """
    chunk = F.expr("slot div 1000")
    rows = stage(combined_sessions(partials, key), "session-rows")
    reach = stage(running(rows, [key], "slot", {"_reach": peak(F.col("last_ts")).before()}, chunk), "session-reach")
    new = F.coalesce(F.col("first_ts") > F.col("_reach") + F.expr(f"interval {gap}"), F.lit(True)).cast("long")
    numbered = running(reach.withColumn("_new", new), [key], "slot", {"_run": total(F.col("_new"))}, chunk)
    out = numbered.groupBy(key, "_run").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("events").alias("events"))
    return out.drop("_run")
