"""Streams in several micro-batches against the batch result."""

import os
from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from barloom.operators import indicators, signals
from barloom.session import shared_folder
from barloom.sources.prices import scratch
from barloom.streaming import articles, bars, partials, sources, upsert
from barloom.streaming import indicators as running


def walk(n, tickers=("A", "B"), seed=1):
    rng = np.random.default_rng(seed)
    return [
        (t, date(2021, 1, 1) + timedelta(days=i), float(p))
        for t in tickers
        for i, p in enumerate(np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, n))), 4))
    ]


def test_indicators_of_late_and_corrected_bars_equal_batch(spark):
    rows = walk(500)
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    source, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "cp"))
    wrong = df.filter("ticker = 'A' and date = '2021-03-03'").withColumn("close", F.lit(500.0))
    dealt = [df.filter(F.pmod(F.hash("date"), F.lit(3)) == i) for i in (2, 0)] + [wrong, df.filter(F.pmod(F.hash("date"), F.lit(3)) == 1).unionByName(df.filter("date = '2021-03-03'"))]
    for part in dealt:
        part.write.mode("append").parquet(source)
        running.start_indicators(sources.folder(spark, source, df.schema), out, checkpoint, buckets=2)
    running.fold_into(out, 2)(dealt[-1], 3)  # a repeated batch
    got = running.read_indicators(spark, out).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    want = indicators.add(df, indicators.sma(20), indicators.sma(50), *signals.mean_reversion()).toPandas()
    want = want.sort_values(["ticker", "date"]).reset_index(drop=True)
    assert len(got) == len(want) == 1000
    for c in ("close", "sma_20", "sma_50", "bb_upper", "bb_lower", "rsi", "macd", "macd_signal", "macd_hist"):
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)


def test_a_batch_folded_in_passes_leaves_only_the_table(spark, monkeypatch):
    monkeypatch.setattr(running, "PASS_ROWS", 100)
    assert running._passes({3: 40, 0: 60, 1: 60, 2: 200, 4: 50}) == [[0], [1], [2], [3, 4]]
    df = spark.createDataFrame(walk(60, "ABCDE"), "ticker string, date date, close double")
    folder = shared_folder(spark).removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    out, before = scratch(spark, "passes"), set(os.listdir(folder))
    for i in (1, 0):
        running.fold_into(out, 4)(df.filter(F.pmod(F.hash("date"), F.lit(2)) == i), i)
    assert set(os.listdir(folder)) - before == {os.path.basename(out)}
    got = running.read_indicators(spark, out).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    want = running.compute(df).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    assert len(got) == len(want) == 300
    for c in ("close", "sma_50", "bb_upper", "rsi", "macd_signal", "state_n"):
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)


def test_daily_bars_keep_open_days_back(spark):
    ticks = [(i, "A", datetime(2024, 1, 1) + timedelta(hours=6 * i), 10.0 + i, 1) for i in range(20)]
    df = spark.createDataFrame(ticks, "seq long, ticker string, ts timestamp, price double, quantity long")
    source = scratch(spark, "ticks")
    df.write.parquet(source)
    out = sources.replay(bars.daily_bars(sources.folder(spark, source, df.schema)), "bars").orderBy("date").collect()
    assert [r.date.day for r in out] == [1, 2, 3]  # the newest tick is on day 5, ticks may be a day late
    assert (out[0].open, out[0].high, out[0].low, out[0].close, out[0].volume) == (10.0, 13.0, 10.0, 13.0, 4)


def test_articles_once_across_batches(spark):
    source, out, checkpoint = (scratch(spark, n) for n in ("arts", "once", "cp"))
    schema = "canonical_url string, published_at timestamp"
    for batch in (["a?x=1", "b"], ["a#top", "c"], ["b?y", "c"]):
        rows = [(f"https://n.example/{u}", datetime(2024, 1, 1, 12)) for u in batch]
        df = spark.createDataFrame(rows, schema)
        df.write.mode("append").parquet(source)
        sources.drain(articles.unique_articles(sources.folder(spark, source, df.schema)), out, checkpoint)
    got = [r.canonical_url for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [f"https://n.example/{u}" for u in "abc"]


def test_upsert_stream_survives_repeats_and_late_changes(spark):
    source, table, checkpoint = (scratch(spark, n) for n in ("chg", "latest", "cp"))
    schema = "seq long, k string, op string, v int"
    batches = [
        [(1, "a", "U", 1), (2, "b", "U", 2), (3, "a", "U", 3)],
        [(5, "b", "D", None), (6, "c", "U", 6)],
        [(4, "b", "U", 4), (2, "c", "U", 0), (7, "a", "U", 7)],  # the first two are older than what is known
    ]
    for batch in batches:
        df = spark.createDataFrame(batch, schema)
        df.write.mode("append").parquet(source)
        upsert.start_upsert(sources.folder(spark, source, df.schema), table, checkpoint, ["k"], buckets=4)
    write = upsert.upsert_into(table, df.schema, ["k"], buckets=4)
    write(spark.createDataFrame(batches[2], schema), 2)  # a repeated batch
    got = sorted((r.k, r.v) for r in upsert.read_latest(spark, table, df.schema).collect())
    assert got == [("a", 7), ("c", 6)]


def test_late_rows_count_in_any_batch(spark):
    days = [1, 5, 6, 2, 1, 9]
    rows = [(i, "A", datetime(2024, 1, d, 3 + i), 10.0 + i, 1, f"https://n.example/{d}?q={i}") for i, d in enumerate(days)]
    schema = "seq long, ticker string, ts timestamp, price double, quantity long, canonical_url string"
    source, out, once = (scratch(spark, n) for n in ("late", "late-bars", "late-articles"))
    for row in rows:
        df = spark.createDataFrame([row], schema)
        df.write.mode("append").parquet(source)
        stream = sources.folder(spark, source, df.schema)
        partials.start(stream, out, f"{source}-a", lambda batch, _: bars.partial_bars(batch))
        articles.store_unique(stream, once, f"{source}-b", "ts")
    got = {r.date.day: (r.open, r.close, r.volume) for r in bars.merged_bars(partials.read(spark, out)).collect()}
    assert got == {1: (10.0, 14.0, 2), 5: (11.0, 11.0, 1), 6: (12.0, 12.0, 1), 2: (13.0, 13.0, 1), 9: (15.0, 15.0, 1)}
    assert sorted(r.canonical_url for r in articles.read_unique(spark, once, "ts").collect()) == [f"https://n.example/{d}" for d in (1, 2, 5, 6, 9)]


def test_earliest_article_stays_in_any_order_and_through_merging(spark):
    times = {"a": [5, 3, 9, 3, 1], "b": [2, 2, None, 4, 2], "c": [None, None, 7, 8, 6]}
    schema = "canonical_url string, seq long, published_at timestamp, title string"
    source, out, checkpoint = (scratch(spark, n) for n in ("feed", "kept", "cp"))
    for batch in range(5):
        rows = [(f"https://n.example/{u}?b={batch}", 10 * batch, t[batch] and datetime(2024, 1, t[batch]), f"{u}{batch}") for u, t in times.items()]
        df = spark.createDataFrame(rows, schema)
        df.write.mode("append").parquet(source)
        articles.store_unique(sources.folder(spark, source, df.schema), out, checkpoint, order="seq", buckets=4)
        if batch == 3:
            held = partials.read(spark, out).count()
            partials.compact(spark, out, lambda r: articles._earliest(r, "published_at", "seq"), ["bucket"])
            assert partials.read(spark, out).count() == 3 < held and partials.read(spark, out).select("batch").distinct().count() == 1
    got = {(r.canonical_url[-1], r.title, r.seq) for r in articles.read_unique(spark, out, order="seq").collect()}
    assert got == {("a", "a4", 40), ("b", "b0", 0), ("c", "c4", 40)}


def test_merging_that_was_broken_off_is_finished(spark):
    path = scratch(spark, "broken")
    for batch in range(3):
        spark.range(batch, batch + 1).write.parquet(f"{path}/batch={batch}")
    spark.range(3).write.parquet(f"{path}/{partials.MERGED}2")  # written to the end, old folders not yet deleted
    partials._finish(spark, path)
    assert sorted(r.id for r in partials.read(spark, path).collect()) == [0, 1, 2]


def test_only_touched_buckets_are_read(spark):
    path = scratch(spark, "buckets")
    spark.createDataFrame([(f"u{i}", i, i % 4, "x") for i in range(40)], "canonical_url string, seq int, bucket int, body string").write.partitionBy("bucket").parquet(f"{path}/batch=0")
    plan = articles.stored_keys(spark, path, 1, [2], ["canonical_url", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "ReadSchema: struct<canonical_url:string,seq:int>" in plan


def test_sessions_of_a_busy_key_are_spread(spark):
    rng = np.random.default_rng(2)
    start = datetime(2024, 1, 1)
    rows = [("hot", start + timedelta(seconds=int(s))) for s in rng.integers(0, 4_000_000, 4000)] + [(f"k{i % 7}", start + timedelta(seconds=int(s))) for i, s in enumerate(rng.integers(0, 4_000_000, 900))]
    rows += [("edge", start), ("edge", start + timedelta(minutes=10)), ("edge", start + timedelta(minutes=20, seconds=1)), ("edge", None)]
    df = spark.createDataFrame(rows, "user string, ts timestamp")
    parts = [bars.partial_sessions(df.filter(F.pmod(F.xxhash64("user", "ts"), F.lit(3)) == i), "user", "10 minutes") for i in range(3)]
    out = bars.merged_sessions(parts[0].unionByName(parts[1]).unionByName(parts[2]), "user", "10 minutes")
    want, held = [], {}
    for user, ts in sorted((r for r in rows if r[1]), key=lambda r: r[1]):
        if user in held and ts - held[user][2] <= timedelta(minutes=10):
            held[user][2] = ts
            held[user][3] += 1
        else:
            held[user] = [user, ts, ts, 1]
            want.append(held[user])
    assert sorted(map(tuple, out.select("user", "first_ts", "last_ts", "events").collect())) == sorted(map(tuple, want))
    plan = parts[0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Session" not in plan and "partial_count" in plan
