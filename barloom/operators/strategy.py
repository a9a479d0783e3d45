"""Evaluation of buy and sell signals: clusters, trades, metrics and equity curves.

All steps are joins, aggregates and two-level scans, so no task holds a whole series. The pairing of clusters has a closed form: with
f(k) the number of sell clusters that start on or before the chosen day of buy cluster k, the first unused sell cluster that
starts later is number k + max over j <= k of (f(j) - j).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators import indicators, signals, timeframes
from barloom.operators.blocks import latest, peak, product, running, total
from barloom.sources.tables import stage

# The row of a cluster each case trades on, as a quantile.
CASES = {"min": 0.0, "average": 0.5, "greedy": 0.75}


def cluster(events: DataFrame, keys: Sequence[str], gap_days: int = 3) -> DataFrame:
    """Number the events of each key (``signal_no``) and group those at most ``gap_days`` apart (``cluster``, from 0)."""
    seen = running(events, keys, "date", {"_was": latest(F.col("date")).before(), "_no": total(F.lit(1)).before()})
    opens = F.col("_was").isNull() | (F.datediff("date", "_was") > gap_days)
    marked = seen.withColumn("_opens", opens.cast("int")).withColumn("signal_no", F.coalesce("_no", F.lit(0)))
    out = running(marked, keys, "date", {"_cluster": total(F.col("_opens"))})
    return out.withColumn("cluster", F.col("_cluster") - 1).drop("_was", "_no", "_opens", "_cluster")


def pick(clustered: DataFrame, keys: Sequence[str], cases: dict[str, float] = CASES) -> DataFrame:
    """One row per (keys, cluster, case): the cluster's start and size and the event the case trades on."""
    sizes = clustered.groupBy(*keys, "cluster").agg(
        F.min("date").alias("start_date"), F.count(F.lit(1)).alias("size"), F.min("signal_no").alias("_first")
    )
    fan = F.array(*[F.struct(F.lit(c).alias("case"), F.lit(q).alias("_q")) for c, q in cases.items()])
    wanted = sizes.select("*", F.inline(fan)).withColumn(
        "signal_no", F.col("_first") + F.bround(F.col("_q") * (F.col("size") - 1)).cast("long")
    )
    rows = clustered.select(*keys, "signal_no", "date", "close")
    return wanted.join(rows, [*keys, "signal_no"]).select(*keys, "case", "cluster", "start_date", "size", "date", "close")


def pair_clusters(picked: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trades: each buy cluster with the first unused sell cluster starting after its chosen day, else with the last bar.

    ``picked`` has a ``side`` column; ``ends`` holds ``last_date`` and ``last_close`` per key.
    """
    keys = list(keys)
    group = [*keys, "case"]
    buys, sells = picked.filter("side = 'buy'"), picked.filter("side = 'sell'")
    events = buys.select(*group, F.col("date").alias("at"), F.lit(1).alias("turn"), "cluster").unionByName(
        sells.select(*group, F.col("start_date").alias("at"), F.lit(0).alias("turn"), "cluster")
    )
    counted = running(events, group, ["at", "turn"], {"_started": total(1 - F.col("turn"))}).filter("turn = 1")
    ahead = running(
        counted.withColumn("_ahead", F.col("_started") - F.col("cluster")), group, "at", {"_skip": peak(F.col("_ahead"))}
    )
    matched = ahead.select(*group, "cluster", (F.col("cluster") + F.col("_skip")).alias("exit_cluster"))
    exits = sells.select(
        *group, F.col("cluster").alias("exit_cluster"), F.col("date").alias("exit_date"), F.col("close").alias("exit_price")
    )
    return (
        buys.select(*group, "cluster", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
        .join(matched, [*group, "cluster"])
        .join(exits, [*group, "exit_cluster"], "left")
        .join(ends, keys)
        .select(
            *group,
            F.col("cluster").alias("trade_no"),
            "entry_date",
            "entry_price",
            F.coalesce("exit_date", "last_date").alias("exit_date"),
            F.coalesce("exit_price", "last_close").alias("exit_price"),
            F.col("exit_date").isNotNull().alias("closed_by_signal"),
        )
    )


def gain() -> Column:
    return F.col("exit_price") / F.col("entry_price") - 1


def with_return(trades: DataFrame) -> DataFrame:
    """Trade table with the return in percent."""
    return trades.withColumn("return_pct", gain() * 100)


def grid(ends: DataFrame, cases: dict[str, float] = CASES) -> DataFrame:
    """Every series with every case, so that series without trades keep a row."""
    return ends.withColumn("case", F.explode(F.array(*[F.lit(c) for c in cases])))


def metrics(trades: DataFrame, ends: DataFrame, keys: Sequence[str], cases: dict[str, float] = CASES) -> DataFrame:
    """Count, total and annualised return, win rate, mean return, mean holding days and worst drawdown per (keys, case)."""
    group = [*keys, "case"]
    grown = running(
        trades.withColumn("_gain", gain()),
        group,
        ["entry_date", "trade_no"],
        {"_equity": product(1 + F.col("_gain"))},
    )
    # a scan reads its input twice, so what it reads is written first
    peaked = running(stage(grown, "grown"), group, ["entry_date", "trade_no"], {"_peak": peak(F.col("_equity"))})
    top = F.greatest("_peak", F.lit(1.0))  # the curve starts at 1
    summary = peaked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("num_trades"),
        F.max_by("_equity", F.struct("entry_date", "trade_no")).alias("_final"),
        F.avg((F.col("_gain") > 0).cast("double")).alias("win_rate"),
        F.avg("_gain").alias("avg_return_per_trade"),
        F.min_by("entry_date", "trade_no").alias("_from"),
        F.max_by("exit_date", "trade_no").alias("_to"),
        F.least(F.lit(0.0), F.min((F.col("_equity") - top) / top)).alias("_fall"),
        F.avg(F.datediff("exit_date", "entry_date")).alias("avg_holding_days"),
    )
    days = F.greatest(F.lit(1), F.datediff("_to", "_from"))
    known = summary.select(
        *group,
        "num_trades",
        ((F.col("_final") - 1) * 100).alias("total_return_pct"),
        "win_rate",
        "avg_return_per_trade",
        ((F.pow(F.col("_final"), F.lit(365.0) / days) - 1) * 100).alias("annualized_return_pct"),
        (F.col("_fall") * 100).alias("max_drawdown_pct"),
        "avg_holding_days",
    )
    zero = {c: 0.0 for c in ("total_return_pct", "win_rate", "avg_return_per_trade", "max_drawdown_pct")}
    return grid(ends, cases).select(*group).join(known, group, "left").na.fill({"num_trades": 0, **zero})


def equity_curve(trades: DataFrame, ends: DataFrame, keys: Sequence[str], cases: dict[str, float] = CASES) -> DataFrame:
    """Step curve per (keys, case): ``step_no``, ``date``, ``value``.

    Starts at 1 on the range's first day. A trade adds the day before its exit at the old value, if that is later than the last point, and
    its exit at the new one. The last bar closes the curve. A series without trades is flat, one point per calendar day.
    """
    group = [*keys, "case"]
    order = ["exit_date", "trade_no"]
    span = ends.select(*keys, "start_date", F.col("last_date").alias("_end"))
    grown = running(
        trades.withColumn("_gain", 1 + gain()),
        group,
        order,
        {
            "_after": product(F.col("_gain")),
            "_before": product(F.col("_gain")).before(),
            "_was": latest(F.col("exit_date")).before(),
        },
    ).join(span, list(keys))
    grown = stage(grown, "grown")
    was = F.coalesce("_was", "start_date")
    eve = F.date_sub("exit_date", 1)
    point = lambda part, day, value: F.struct(F.lit(part).alias("part"), day.alias("date"), value.alias("value"))
    steps = grown.select(
        *group,
        "trade_no",
        F.inline(
            F.filter(
                F.array(
                    F.when(eve > was, point(1, eve, F.coalesce("_before", F.lit(1.0)))),
                    point(2, F.col("exit_date"), F.col("_after")),
                ),
                lambda p: p.isNotNull(),
            )
        ),
    )
    finals = grown.groupBy(*group).agg(
        F.max_by("_after", F.struct(*order)).alias("value"),
        F.max("exit_date").alias("_last_exit"),
        F.first("_end").alias("_end"),
        F.first("start_date").alias("start_date"),
    )
    opening = finals.select(*group, F.lit(-1).cast("long").alias("trade_no"), F.lit(0).alias("part"), F.col("start_date").alias("date"), F.lit(1.0).alias("value"))
    closing = finals.filter(F.col("_end") > F.greatest("_last_exit", "start_date")).select(
        *group, F.lit(2**62).alias("trade_no"), F.lit(3).alias("part"), F.col("_end").alias("date"), "value"
    )
    idle = grid(ends, cases).join(trades.select(*group).distinct(), group, "left_anti")
    flat = idle.select(
        *group,
        F.lit(-1).cast("long").alias("trade_no"),
        F.lit(0).alias("part"),
        F.explode(F.sequence("start_date", "last_date", F.expr("interval 1 day"))).alias("date"),
        F.lit(1.0).alias("value"),
    )
    points = stage(opening.unionByName(steps).unionByName(closing).unionByName(flat), "points")
    numbered = running(points, group, ["date", "trade_no", "part"], {"_no": total(F.lit(1))})
    return numbered.select(*group, (F.col("_no") - 1).alias("step_no"), "date", "value")


def signal_events(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per raised flag, with its ``side``."""
    sides = F.filter(
        F.array(F.when(F.col("buy_signal"), F.lit("buy")), F.when(F.col("sell_signal"), F.lit("sell"))), lambda s: s.isNotNull()
    )
    return flagged.select(*keys, "date", "close", F.explode(sides).alias("side"))


class Evaluation:
    """Strategy evaluation of every series over every range and case.

    Indicators are recomputed inside each range, so every range has its own warm-up. Intermediate tables that several results
    read are staged once.
    """

    KEYS = ("timeframe", "ticker")

    def __init__(
        self,
        bars: DataFrame,
        rule: signals.Rule = signals.Rule(),
        names: Sequence[str] = timeframes.STRATEGY_NAMES,
        gap_days: int = 3,
        cases: dict[str, float] = CASES,
    ):
        self.cases = cases
        spread = stage(timeframes.fan_out(bars.select("ticker", "date", "close").dropna(), names), "spread")
        flagged = indicators.add(spread, *signals.mean_reversion(rule), keys=self.KEYS)
        self.flagged = stage(
            flagged.select("timeframe", "ticker", "start_date", "date", "close", "buy_signal", "sell_signal"), "flagged"
        )
        self.ends = self.flagged.groupBy(*self.KEYS).agg(
            F.max("start_date").alias("start_date"),
            F.max("date").alias("last_date"),
            F.max_by("close", "date").alias("last_close"),
        )
        side_keys = [*self.KEYS, "side"]
        self.clustered = stage(cluster(signal_events(self.flagged, self.KEYS), side_keys, gap_days), "clustered")
        self.picked = stage(pick(self.clustered, side_keys, cases), "picked")
        self.trades = stage(pair_clusters(self.picked, self.ends.drop("start_date"), self.KEYS), "trades")

    def metrics(self) -> DataFrame:
        return metrics(self.trades, self.ends, self.KEYS, self.cases)

    def equity(self) -> DataFrame:
        return equity_curve(self.trades, self.ends, self.KEYS, self.cases)
