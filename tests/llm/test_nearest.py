"""Neighbours against all distances in double precision."""

import math
import random

import numpy as np

from barloom.llm import nearest


def slow(rows, top=10, every=100):
    ok = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ok = {(i, tuple(v)) for i, v in ok}
    out = set()
    for q in {i for i, _ in ok if i % every == 0}:
        near = {(math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), i) for p, v in ok if p == q for i, w in ok if i != q and len(v) == len(w)}
        out |= {(q, r + 1, i, round(d, 9)) for r, (d, i) in enumerate(sorted(near)[:top])}
    return sorted(out)


def corpus():
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(700)]
    common = [0.5] * 8
    rows += [(i, common) for i in range(700, 1200)] + [(i, [1e-30 * rng.random() for _ in range(8)]) for i in range(1200, 1220)]
    rows += [(i, [1e6 + rng.random() for _ in range(8)]) for i in range(1220, 1320)] + [(i, [1.0, 2.0, float(i % 3)]) for i in range(1400, 1406)]
    rows += [(1500, None), (1501, []), (1600, [0.0] * 8), (1700, [float("nan")] + [1.0] * 7), (1800, [float("inf")] + [1.0] * 7), (1900, [None] + [1.0] * 7)]
    return rows + [(None, common), (300, rows[300][1]), (500, common), (2000, [1.0] * 5), (2100, [-0.0, 1.0, 0.0]), (2101, [0.0, 1.0, -0.0])]


def test_table(spark, monkeypatch):
    docs = spark.createDataFrame([(v, i, 1) for i, v in corpus()], "embedding array<float>, vec_id bigint, rank int")
    for queries, rows in ((512, 8192), (2, 50)):
        monkeypatch.setattr(nearest, "QUERY_BLOCK", queries)
        monkeypatch.setattr(nearest, "ROW_BLOCK", rows)
        got = sorted((a, b, c, round(d, 9)) for a, b, c, d in nearest.search(docs).collect())
        assert got == slow(corpus())


def test_bounds():
    rng = np.random.default_rng(1)
    for scale in (1e-3, 1.0, 1e5):
        a, b = rng.normal(size=(20, 16)) * scale, rng.normal(size=(30, 16)) * scale + scale * 3
        low, high = nearest.tile_bounds(nearest.quantise(a), nearest.quantise(b))
        true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
        assert (low <= true).all() and (true <= high).all() and (high - low < 0.2 * true.max()).all()


def test_no_rows(spark):
    assert nearest.search(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []
