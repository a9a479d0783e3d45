"""Settings away from the registered queries': wide spans, several changes per key, restated items, missing arguments."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import asof, content, dedupe, financials, indicators, merge, news
from barloom.sources import tables


@pytest.mark.parametrize(("slow", "signal"), [(26, 9), (200, 50), (400, 9)])
def test_exponential_means_at_any_span(spark, slow, signal):
    rng = np.random.default_rng(1)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, 6000)))
    rows = [("A", date(1990, 1, 1) + timedelta(days=i), float(c)) for i, c in enumerate(close)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    out = indicators.add(df, indicators.macd("ewm", 12, slow, signal), block_rows=1000).orderBy("date").toPandas()
    s = pd.Series(close)
    line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=slow, adjust=False).mean()
    assert np.abs(out["macd"] - line).max() < 1e-9
    assert np.abs(out["macd_signal"] - line.ewm(span=signal, adjust=False).mean()).max() < 1e-9


def test_patch_folds_several_changes(spark):
    target = spark.createDataFrame([(1, 10, "a"), (None, 20, "b"), (3, 30, "c")], "k int, x int, y string")
    rows = [(1, 11, None, None, 1), (1, None, "z", None, 2), (1, None, None, ["x"], 3), (None, 21, None, None, 1), (None, 22, None, None, 2), (9, 1, "n", None, 1)]
    changes = spark.createDataFrame(rows, "k int, x int, y string, cleared array<string>, seq int")
    out = merge.patch(target, changes, ["k"], ["x", "y"], cleared="cleared", order="seq")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, None, "z"), (None, 22, "b"), (3, 30, "c")], key=repr)
    with pytest.raises(Exception, match="more than once"):
        merge.patch(target, changes.drop("seq"), ["k"], ["x"], cleared="cleared").collect()


def test_upsert_needs_an_order_for_repeats(spark):
    target = spark.createDataFrame([(1, 10)], "k int, x int")
    twice = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "k int, x int, seq int")
    assert [tuple(r) for r in merge.upsert(target, twice, ["k"], order="seq").collect()] == [(1, 12)]
    with pytest.raises(Exception, match="more than once"):
        merge.upsert(target, twice.drop("seq"), ["k"]).collect()


def test_restated_items(spark):
    rows = [("A", date(2020, 12, 31), "income", "Total Revenue", 5.0, 1), ("A", date(2020, 12, 31), "income", "Total Revenue", 4.0, 2)]
    df = spark.createDataFrame(rows, "ticker string, period_end date, statement string, item string, value double, version int")
    assert float(financials.assemble(df, order="version").head().revenue) == 4.0
    assert float(financials.assemble(df.drop("version")).head().revenue) == 5.0


def test_live_needs_a_time_and_pages_are_as_large_as_asked(spark):
    with pytest.raises(ValueError):
        content.status("live")
    stamp = F.lit("2024-01-01").cast("timestamp")
    df = spark.range(700).select("id", stamp.alias("created_at"), stamp.alias("published_at"))
    assert content.page(df, 1, 500).count() == 500


def test_tickers_with_dots_and_dashes(spark):
    df = spark.createDataFrame([(1, "Buy BRK.B, or bf-b today", "x.")], "seq int, title string, snippet string")
    names = spark.createDataFrame([("BRK.B",), ("BF-B",), ("X",), ("ABC",)], "ticker string")
    assert {r.ticker for r in news.tag_tickers(df, names).collect()} == {"BRK.B", "BF-B", "X"}


def test_many_leading_rows_are_still_cut_before_the_shuffle(spark):
    out = dedupe.top_per_key(spark.range(100_000).withColumn("k", F.col("id") % 2), ["k"], 5000, F.col("id").asc())
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_a_table_can_be_written_over_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace(spark.range(10), path)
    tables.write_table(spark.read.parquet(path).filter("id < 4"), path)
    assert spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize(("strict", "keys"), [(False, []), (True, []), (False, ["k"]), (True, ["k"])])
def test_as_of_facts_whose_texts_are_never_null(spark, strict, keys):
    facts = spark.createDataFrame([("a", date(2023, 12, 31)), ("a", date(2024, 1, 2))], "k string, day date").withColumn("note", F.lit("text"))
    asked = spark.createDataFrame([("a", date(2023, 12, 30 + i) if i < 2 else date(2024, 1, i - 1), i) for i in range(5)], "k string, day date, no int")
    facts = facts if keys else facts.drop("k")
    got = {r.no: (r.fact_day, r.note) for r in asof.backward(asked, facts, "day", keys, strict).collect()}
    old, new = (date(2023, 12, 31), "text"), (date(2024, 1, 2), "text")
    assert got == {0: (None, None), 1: (None, None) if strict else old, 2: old, 3: old if strict else new, 4: new}
