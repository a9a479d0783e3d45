"""Work in bounded pieces equals work over whole series, also for a key that holds most rows."""

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import blocks, indicators, signals


def skewed(spark, rows=4000):
    """One ticker with most rows over many years, and some short ones."""
    rng = np.random.default_rng(7)
    frames = []
    for ticker, n in (("HOT", rows), ("A", 30), ("B", 1), ("C", 200)):
        days = np.sort(rng.choice(8000, n, replace=False))
        close = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, n))), 4)
        frames.append(pd.DataFrame({"ticker": ticker, "date": [date(1990, 1, 1) + timedelta(days=int(d)) for d in days], "close": close}))
    pdf = pd.concat(frames)
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("block_rows,lookback", [(366, 5), (500, 49), (1000, 1200), (100000, 10)])
def test_place_gives_every_row_its_lookback(spark, block_rows, lookback):
    df, _ = skewed(spark)
    placed = blocks.place(df, ["ticker"], "date", lookback, block_rows)
    frame = placed.window.rowsBetween(-lookback, 0)
    got = placed.with_columns({"s": F.count("close").over(frame), "first": F.min("date").over(frame), "pos": F.col("_pos")}).finish()
    w = Window.partitionBy("ticker").orderBy("date")
    whole = w.rowsBetween(-lookback, 0)
    want = df.withColumns({"s": F.count("close").over(whole), "first": F.min("date").over(whole), "pos": (F.row_number().over(w) - 1).cast("long")})
    assert got.count() == df.count()
    assert got.select(*want.columns).exceptAll(want).isEmpty()


def test_blocks_are_bounded(spark):
    df, _ = skewed(spark)
    placed = blocks.place(df, ["ticker"], "date", 50, 500)
    largest = placed.df.groupBy("ticker", "_blk").count().agg(F.max("count")).first()[0]
    assert largest <= 500 + 50 + 2 * 366


def test_running_equals_whole_windows(spark):
    df, _ = skewed(spark)
    df = df.withColumn("maybe", F.when(F.col("close") > 100, F.col("close")))
    got = blocks.running(
        df,
        ["ticker"],
        "date",
        {
            "total": blocks.total(F.lit(1)),
            "was": blocks.latest(F.col("close")).before(),
            "seen": blocks.latest(F.col("maybe")),
            "top": blocks.peak(F.col("close")),
            "top_before": blocks.peak(F.col("close")).before(),
        },
    )
    w = Window.partitionBy("ticker").orderBy("date")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumns(
        {
            "total": F.count(F.lit(1)).over(upto),
            "was": F.lag("close").over(w),
            "seen": F.last("maybe", True).over(upto),
            "top": F.max("close").over(upto),
            "top_before": F.max("close").over(before),
        }
    )
    assert got.select(*want.columns).exceptAll(want).isEmpty()


def test_running_product(spark):
    df, pdf = skewed(spark)
    got = blocks.running(df, ["ticker"], "date", {"p": blocks.product(1 + (F.col("close") - 100) / 100000)}).toPandas()
    hot = got[got.ticker == "HOT"].sort_values("date")
    source = pdf[pdf.ticker == "HOT"].sort_values("date")
    np.testing.assert_allclose(hot["p"], (1 + (source["close"] - 100) / 100000).cumprod(), rtol=1e-9)


def test_running_keeps_decimals(spark):
    rows = [("A", date(2000 + i, 1, 1), Decimal("0.00000001")) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, date date, v decimal(26,8)")
    out = blocks.running(df, ["k"], "date", {"s": blocks.total(F.col("v"))})
    assert out.agg(F.max("s")).first()[0] == Decimal("0.00000030")


def test_running_carries_structs_whose_fields_are_never_null(spark):
    df, _ = skewed(spark, 300)
    df = df.withColumn("_row", F.when(F.col("close") > 100, F.struct("date", F.lit("text").alias("note"), "close")))
    got = blocks.running(df, ["ticker"], "date", {"last": blocks.latest(F.col("_row")), "was": blocks.latest(F.col("_row")).before()})
    w = Window.partitionBy("ticker").orderBy("date")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumns({"last": F.last("_row", True).over(upto), "was": F.last("_row", True).over(before)})
    assert got.count() == df.count()
    assert got.select("ticker", "date", "last.*", "was.note").exceptAll(want.select("ticker", "date", "last.*", "was.note")).isEmpty()


def test_exponential_means_restart_exactly_enough(spark):
    df, pdf = skewed(spark, 6000)
    got = indicators.add(df, indicators.macd(), indicators.rsi("wilder"), block_rows=1500).toPandas()
    for ticker, part in pdf.groupby("ticker"):
        part = part.sort_values("date").reset_index(drop=True)
        mine = got[got.ticker == ticker].sort_values("date").reset_index(drop=True)
        assert len(mine) == len(part)
        fast, slow = (part.close.ewm(span=s, adjust=False).mean() for s in (12, 26))
        line = (fast - slow).ewm(span=9, adjust=False).mean()
        np.testing.assert_allclose(mine.macd, fast - slow, atol=1e-9)
        np.testing.assert_allclose(mine.macd_signal, line, atol=1e-9)
        delta = part.close.diff()
        up = delta.clip(lower=0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        down = (-delta.clip(upper=0)).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        rsi = (100 - 100 / (1 + up / down.replace(0, np.nan))).fillna(50.0)
        np.testing.assert_allclose(mine.rsi, rsi, atol=1e-8)


def test_wilder_all_gains_read_neutral(spark):
    rows = [("A", date(2024, 1, 1) + timedelta(days=i), 100.0 + i) for i in range(40)]
    out = indicators.add(spark.createDataFrame(rows, "ticker string, date date, close double"), indicators.rsi("wilder"))
    assert {r.rsi for r in out.collect()} == {50.0}


def test_sample_band_is_null_on_first_row_and_fillable(spark):
    df = spark.createDataFrame([("A", date(2024, 1, 1), 10.0), ("A", date(2024, 1, 2), 12.0)], "ticker string, date date, close double")
    plain = indicators.add(df, indicators.bollinger(20, 1)).orderBy("date").collect()
    filled = indicators.add(df, indicators.bollinger(20, 1, fill=0.0)).orderBy("date").collect()
    assert plain[0].bb_upper is None and filled[0].bb_upper == 10.0
    assert plain[1].bb_std == pytest.approx(2**0.5)


def test_require_all_buys_on_a_rising_histogram_below_the_band(spark):
    """A rule loose enough that all three conditions meet, checked against pandas."""
    df, pdf = skewed(spark)
    rule = signals.Rule(bb_window=5, rsi_buy=60.0, macd_hist_threshold=-0.3)
    got = indicators.add(df.filter("ticker = 'HOT'"), *signals.mean_reversion(rule)).toPandas().sort_values("date").reset_index(drop=True)
    x = pdf[pdf.ticker == "HOT"].sort_values("date").close.reset_index(drop=True)
    mid, std = x.rolling(5, min_periods=1).mean(), x.rolling(5, min_periods=1).std(ddof=0).fillna(0)
    was = got.macd_hist.shift(1).fillna(0.0)
    buy = (x < mid - 2 * std) & (got.rsi < 60) & (got.macd_hist > -0.3) & (was <= -0.3)
    sell = (x > mid + 2 * std) | (got.rsi > 70) | (got.macd_hist < -0.3)
    assert (got.buy_signal == buy).all() and (got.sell_signal == sell).all()


def means_of(pdf, fast, slow, signal):
    out = pdf.sort_values(["ticker", "date"]).copy()
    ewm = lambda span: out.groupby("ticker")["close"].transform(lambda c: c.ewm(span=span, adjust=False).mean())
    out["macd"] = ewm(fast) - ewm(slow)
    out["macd_signal"] = out.groupby("ticker")["macd"].transform(lambda c: c.ewm(span=signal, adjust=False).mean())
    return out


@pytest.mark.parametrize("fast,slow,signal", [(12, 26, 9), (100, 200, 50), (2, 200, 3)])
def test_means_of_any_span_equal_whole_series(spark, fast, slow, signal):
    df, pdf = skewed(spark)
    got = indicators.add(df, indicators.macd("ewm", fast, slow, signal), block_rows=64).toPandas().sort_values(["ticker", "date"])
    want = means_of(pdf, fast, slow, signal)
    for c in ("macd", "macd_signal"):
        assert np.allclose(got[c].to_numpy(), want[c].to_numpy(), rtol=0, atol=1e-9)


def test_blocks_borrow_no_more_rows_than_they_hold(spark, monkeypatch):
    df, _ = skewed(spark)
    seen = []
    monkeypatch.setattr(indicators, "place", lambda *args: seen.append(blocks.place(*args)) or seen[-1])
    indicators.add(df, indicators.rsi("wilder", rows=20), block_rows=64)
    assert seen[0].df.count() <= 3 * df.count()
    assert seen[0].df.groupBy("ticker", "_blk").count().agg(F.max("count")).first()[0] <= seen[0].rows


def test_means_add_no_sort_of_their_own(spark):
    df, _ = skewed(spark, 300)
    out = indicators.add(df, *signals.mean_reversion())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sum("_blk#" in line for line in plan.splitlines() if " Sort [" in line) == 1


def test_tasks_of_place_follow_the_rows(spark, monkeypatch):
    df, _ = skewed(spark)
    monkeypatch.setattr(blocks, "TASK_ROWS", 50)
    placed = blocks.place(df, ["ticker"], "date", 5, 366)
    assert placed.df.rdd.getNumPartitions() >= df.count() // 50


def test_tasks_of_running_follow_the_rows(spark, monkeypatch):
    df, _ = skewed(spark)
    monkeypatch.setattr(blocks, "TASK_ROWS", 50)
    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 0)
    got = blocks.running(df, ["ticker"], "date", {"n": blocks.total(F.lit(1))})
    assert got.rdd.getNumPartitions() >= df.count() // 50
    assert got.groupBy("ticker").agg(F.max("n"), F.count("n")).filter("max(n) <> count(n)").isEmpty()
