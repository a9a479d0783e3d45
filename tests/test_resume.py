"""Indicators gone on with from stored state equal those of a run over all bars."""

import os
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import incremental, indicators
from barloom.operators.resume import advance
from barloom.operators.signals import batch_rule
from barloom.plans import price_table
from barloom.session import shared_folder
from barloom.sources.tables import stage

SCHEMA = "ticker string, date date, close double"


def history(spark, sizes=(("A", 700), ("B", 3), ("C", 60), ("NEW", 1))):
    rng = np.random.default_rng(3)
    rows = []
    for t, n in sizes:
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
        rows += [(t, date(2020, 1, 1) + timedelta(days=800 - n + i), float(c)) for i, c in enumerate(close)]
    return spark.createDataFrame(rows, SCHEMA)


def same(got, want, columns):
    a, b = (x.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) > 0 and a["ticker"].equals(b["ticker"]) and a["date"].equals(b["date"])
    for c in columns:
        if a[c].dtype == float:
            np.testing.assert_allclose(a[c], b[c], rtol=1e-12, atol=1e-11, err_msg=c)
        else:
            assert a[c].equals(b[c]), c


def whole(df):
    return indicators.add(df, indicators.rsi("wilder"), indicators.macd(), indicators.bollinger(20, ddof=0), keep_state=True)


@pytest.mark.parametrize("days", [1, 5, 30, 650])
def test_any_row_can_be_gone_on_from(spark, days):
    df = history(spark)
    edge = date(2020, 1, 1) + timedelta(days=800 - days)
    stored = whole(df.filter(F.col("date") < F.lit(edge)))
    since = df.filter(F.col("date") >= F.lit(edge)).groupBy("ticker").agg(F.min("date").alias("_from"))
    got = advance(df, stored, since, whole, 20)
    want = whole(df).filter(F.col("date") >= F.lit(edge))
    same(got, want, ["rsi", "macd", "macd_signal", "macd_hist", "bb_upper", "state_n", "state_fast", "state_avg_down"])


def test_signals_that_hold(spark):
    df = history(spark)
    table = price_table.build(df.filter("date < '2022-03-09'"), digits=None, state=True)
    got = price_table.update(table, df, date(2022, 3, 11), digits=None)
    rebuilt = price_table.build(df.filter("date < '2022-03-11'"), digits=None, state=True)
    last = rebuilt.groupBy("ticker").agg(F.max("date").alias("date"))
    columns = [c for c in rebuilt.columns if c not in ("ticker", "date")]
    same(got.join(last, ["ticker", "date"]), rebuilt.join(last, ["ticker", "date"]), columns)


def test_updates_that_follow_each_other_store_new_rows_only(spark):
    df = history(spark)
    out = stage(price_table.build(df.filter("date < '2022-03-09'"), digits=None, state=True), "price-table")
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    for day in (10, 11):
        out = price_table.update(out, df, date(2022, 3, day), digits=None)
    rows = [spark.read.parquet(f"{folder}/{n}").count() for n in set(os.listdir(folder)) - before if n.startswith("newest-rows")]
    assert sorted(rows) == [3, 4]  # one ticker begins on the last day
    rebuilt = price_table.build(df.filter("date < '2022-03-11'"), digits=None, state=True)
    same(out, rebuilt, [c for c in rebuilt.columns if c not in ("ticker", "date", "buy_signal", "sell_signal")])


def test_no_history_is_read_where_state_is_stored(spark):
    df = history(spark)
    stored = price_table.build(df, digits=None, state=True)
    seen = []

    def spy(frame):
        seen.append(frame.groupBy("ticker").count().toPandas().set_index("ticker")["count"].to_dict())
        return batch_rule(frame, keep_state=True)

    since = df.groupBy("ticker").agg(F.max("date").alias("_from"))
    advance(df, stored, since, spy, 20, 5).collect()
    assert seen == [{"A": 26, "B": 3, "C": 26, "NEW": 1}]
    assert incremental.newest_bar(df, stored.limit(0), date(2030, 1, 1)).count() == 4  # no state: from the first bar


def test_means_with_gaps_equal_pandas(spark):
    rng = np.random.default_rng(5)
    close = pd.Series(np.where(rng.random(3000) < 0.3, np.nan, 50 + np.cumsum(rng.normal(0, 1, 3000))))
    close[:3] = np.nan
    close[1000:1700] = np.nan
    rows = [("A", date(1990, 1, 1) + timedelta(days=i), None if np.isnan(c) else float(c)) for i, c in enumerate(close)]
    got = indicators.add(spark.createDataFrame(rows, SCHEMA), indicators.macd(), block_rows=4096).orderBy("date").toPandas()
    line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
    np.testing.assert_allclose(got["macd"].astype(float), line, atol=1e-10)
    np.testing.assert_allclose(got["macd_signal"].astype(float), line.ewm(span=9, adjust=False).mean(), atol=1e-10)


def test_weights_of_very_different_means(spark):
    rng = np.random.default_rng(6)
    close = pd.Series(50 + np.cumsum(rng.normal(0, 1, 4000)))
    rows = [("A", date(1990, 1, 1) + timedelta(days=i), float(c)) for i, c in enumerate(close)]
    got = indicators.add(spark.createDataFrame(rows, SCHEMA), indicators.macd("ewm", 1, 300, 2), block_rows=100_000).orderBy("date").toPandas()
    line = close - close.ewm(span=300, adjust=False).mean()
    np.testing.assert_allclose(got["macd"], line, atol=1e-9)
    np.testing.assert_allclose(got["macd_signal"], line.ewm(span=2, adjust=False).mean(), atol=1e-9)
