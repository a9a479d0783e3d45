"""Clusters, pairing, metrics and curves against plain loops."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from barloom.operators import strategy

DAY0 = date(2020, 1, 1)


def scenario(seed, n=260):
    """Random bars with flags; returns rows (date, close, buy, sell)."""
    rng = random.Random(seed)
    day, out = 0, []
    for _ in range(n):
        day += rng.choice([1, 1, 1, 2, 3, 4, 9])
        out.append((DAY0 + timedelta(days=day), round(rng.uniform(50, 150), 2), rng.random() < 0.15, rng.random() < 0.2))
    return out


def loop_clusters(rows, flag, gap=3):
    out = []
    for r in rows:
        if not r[flag]:
            continue
        if out and (r[0] - out[-1][-1][0]).days <= gap:
            out[-1].append(r)
        else:
            out.append([r])
    return out


def loop_trades(rows, q):
    """Buy clusters in order, each with the first sell cluster not used before."""
    buys, sells = loop_clusters(rows, 2), loop_clusters(rows, 3)
    at = lambda c: c[round(q * (len(c) - 1))]
    free, trades = list(sells), []
    for b in map(at, buys):
        while free and free[0][0][0] <= b[0]:
            free.pop(0)
        s = at(free.pop(0)) if free else rows[-1]
        trades.append((b[0], b[1], s[0], s[1]))
    return trades


def test_trades_metrics_and_curve(spark):
    seeds = range(12)
    rows = [(f"T{s:02d}", *r) for s in seeds for r in scenario(s)]
    rows += [("NONE", DAY0 + timedelta(days=i), 10.0, False, True) for i in range(5)]
    flagged = spark.createDataFrame(rows, "ticker string, date date, close double, buy_signal boolean, sell_signal boolean").cache()
    ends = flagged.groupBy("ticker").agg(
        F.lit(DAY0).alias("start_date"), F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_close")
    )
    clustered = strategy.cluster(strategy.signal_events(flagged, ["ticker"]), ["ticker", "side"]).cache()
    picked = strategy.pick(clustered, ["ticker", "side"]).cache()
    trades = strategy.pair_clusters(picked, ends.drop("start_date"), ["ticker"]).cache()
    got = {}
    for r in trades.orderBy("ticker", "case", "trade_no").collect():
        got.setdefault((r.ticker, r["case"]), []).append((r.entry_date, r.entry_price, r.exit_date, r.exit_price))
    metrics = {(r.ticker, r["case"]): r for r in strategy.metrics(trades, ends, ["ticker"]).collect()}
    curves = {}
    for r in strategy.equity_curve(trades, ends, ["ticker"]).orderBy("ticker", "case", "step_no").collect():
        curves.setdefault((r.ticker, r["case"]), []).append((r.date, r.value))
    for s in seeds:
        bars = scenario(s)
        for case, q in strategy.CASES.items():
            key = (f"T{s:02d}", case)
            want = loop_trades(bars, q)
            assert got[key] == want, key
            equity, low, top = 1.0, 0.0, 1.0
            for t in want:
                equity *= t[3] / t[1]
                top = max(top, equity)
                low = min(low, equity / top - 1)
            m = metrics[key]
            assert m.num_trades == len(want)
            assert abs(m.total_return_pct - (equity - 1) * 100) < 1e-6
            assert abs(m.max_drawdown_pct - low * 100) < 1e-6
            points, value = [(DAY0, 1.0)], 1.0
            for t in sorted(want, key=lambda t: t[2]):
                eve = t[2] - timedelta(days=1)
                if eve > points[-1][0]:
                    points.append((eve, value))
                value *= t[3] / t[1]
                points.append((t[2], value))
            if bars[-1][0] > points[-1][0]:
                points.append((bars[-1][0], value))
            assert [p[0] for p in curves[key]] == [p[0] for p in points]
            assert all(abs(a[1] - b[1]) < 1e-9 * max(1, b[1]) for a, b in zip(curves[key], points))
    idle = metrics[("NONE", "min")]
    assert (idle.num_trades, idle.total_return_pct, idle.annualized_return_pct, idle.avg_holding_days) == (0, 0.0, None, None)
    assert curves[("NONE", "greedy")] == [(DAY0 + timedelta(days=i), 1.0) for i in range(5)]


def test_picks_round_half_to_even(spark):
    rows = [("A", "buy", DAY0 + timedelta(days=i), float(i)) for i in range(4)]  # 0.5 * 3 = 1.5, 0.75 * 3 = 2.25
    events = spark.createDataFrame(rows, "ticker string, side string, date date, close double")
    out = strategy.pick(strategy.cluster(events, ["ticker", "side"]), ["ticker", "side"])
    assert {r["case"]: r.close for r in out.collect()} == {"min": 0.0, "average": 2.0, "greedy": 2.0}
