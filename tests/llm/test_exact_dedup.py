"""Exact copies against a plain loop; filters against sets."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import exact_dedup
from barloom.llm.exact_dedup import FuseFilter


def slow(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = ids.index(keep)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), k == stays, sha) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def corpus():
    rows = [(i, f"text {i % 70}") for i in range(300)] + [(i, "hot") for i in range(300, 500)]
    rows += [(i, f"only {i}") for i in range(500, 800)] + [(800, None), (801, ""), (802, " "), (803, "Hot"), (804, "hot ")]
    return rows + [(10, "text 10"), (10, "text 10"), (499, "hot"), (None, "hot"), (None, "lost"), (None, "lost"), (900, "x" * 300_000), (901, "x" * 300_000)]


def frame(spark, rows):
    return spark.createDataFrame([(t, i, "k", 1) for i, t in rows], "text string, doc_id bigint, digest string, n int")


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 4])
def test_table(spark, batches):
    assert got(exact_dedup.dedupe(frame(spark, corpus()), batches=batches)) == slow(corpus())


def test_texts_that_share_a_digest(spark):
    """A digest of 16 values: nearly every digest has many texts, and bytes decide."""
    out = exact_dedup.dedupe(frame(spark, corpus()), digest=lambda sha: F.unhex(F.concat(F.lit("0"), F.substring(sha, 1, 1))))
    assert got(out) == slow(corpus())


def test_lists_too_long_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_DIGESTS", 2)
    assert got(exact_dedup.dedupe(frame(spark, corpus()))) == slow(corpus())


def test_no_rows(spark):
    assert exact_dedup.dedupe(frame(spark, []).limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 4096, 20_000])
def test_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-(2**63), 2**63 - 1, n)
    made = FuseFilter.of(np.append(keys, keys[: n // 2]))
    assert made.holds(keys).all()
    others = rng.integers(-(2**63), 2**63 - 1, 50_000)
    assert made.holds(others).mean() < 0.01
    assert n < 1000 or len(made.cells) < 1.4 * n


def test_screen_passes_what_is_known(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_KEYS", 50)
    digests = spark.range(1000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), "id", F.lit(1).alias("n"))
    known = exact_dedup.snapshot(digests.where("id < 500"))
    passed = {bytes(r.digest) for r in exact_dedup.screen(digests, known).collect()}
    inside = {hashlib.sha256(str(i).encode()).digest() for i in range(500)}
    assert known.filters.count() == known.buckets == 11 and inside <= passed and len(passed) < 520
