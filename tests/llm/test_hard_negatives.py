"""Hard negatives against all scores, in whole numbers."""

import math
import random

import numpy as np
import pytest

from barloom.llm import hard_negatives as hn


def slow(rows):
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        codes = [math.floor(256 * float(np.float32(x))) for x in v]
        if any(abs(c) > math.sqrt(9.2e18 / len(v)) for c in codes):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, codes)
        held[i] = min(held.get(i, row), row)
    out = []
    for a, (label, v) in held.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in held.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if held[i][0] == label][:5]:
            near = [i for i in order if held[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(near[:10])]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    rows = [(i, rng.randrange(6), [rng.gauss(0, 0.3) + (i % 3 == k) for k in range(8)]) for i in range(900)]
    common = [0.5, 0.25] * 4
    rows += [(i, 2, common) for i in range(900, 1300)] + [(i, i % 4, [x / 2 for x in common]) for i in range(1300, 1500)]
    rows += [(1500, 1, [0.0] * 8), (1600, 1, [-1.0] * 8), (1601, 1, [1.0] * 8), (1602, 2, [0.01] * 8), (1700, 11, common)]
    rows += [(1800, 1, [3000.0] * 8), (1801, 1, [2900.0] * 8), (1802, 2, [2000.0] * 8), (1803, 3, [4e6] * 8), (1804, 3, [9e6] * 8)]
    rows += [(1900, 1, [1.0, 0.5]), (1901, 1, [1.0, 0.6]), (1902, 4, [0.8, 0.1]), (2000, 3, []), (2001, 3, []), (2002, 4, [])]
    rows += [(None, 1, common), (2100, None, common), (2200, 1, None), (2300, 1, [None] + common[1:]), (2400, 1, [math.nan] + common[1:]), (2500, 1, [math.inf] + common[1:])]
    return rows + [rows[0], rows[300], (300, 5, common), (301, 0, common)]


def frame(spark, rows):
    return spark.createDataFrame([(v, label, i, 1) for i, label, v in rows], "embedding array<float>, label int, vec_id bigint, rank int")


@pytest.mark.parametrize(("anchors", "block"), [(256, 4096), (2, 30)])
def test_table(spark, monkeypatch, anchors, block):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", anchors)
    monkeypatch.setattr(hn, "ROW_BLOCK", block)
    got = sorted(map(tuple, hn.mine(frame(spark, corpus())).collect()))
    want = slow(corpus())
    assert len(want) > 300 and got == want


def test_no_rows(spark):
    assert hn.mine(frame(spark, corpus()).limit(0)).collect() == []


def test_bounds_hold_and_bite():
    rng = np.random.default_rng(2)
    for spread in (0.1, 1.0):
        codes = np.floor(256 * (rng.normal(size=(200, 16)) * spread + np.eye(16)[rng.integers(0, 4, 200)])).astype(np.int32)
        norm, angles = hn.angles_to(codes, hn.references(codes.astype(float)))
        block = hn.Block.__new__(hn.Block)
        block.ids, block.codes, block.norm, block.angles = [[i] for i in range(200)], codes, norm, angles
        low, high = hn.bounds(block, block)
        true = codes.astype(np.int64) @ codes.T
        assert (low <= true).all() and (true <= high).all()
    codes = np.floor(256 * (rng.normal(size=(200, 16)) * 0.05 + np.eye(16)[rng.integers(0, 4, 200)])).astype(np.int32)
    block.codes = codes
    block.norm, block.angles = hn.angles_to(codes, hn.references(codes.astype(float)))
    low, high = hn.bounds(block, block)
    assert (high < 0.5 * 65536).mean() > 0.5  # rows of other clusters are ruled out without a score


@pytest.mark.parametrize("score", [0, 1, 9, 10, 11, 99, 100, -1, -17, 10**17])
def test_window(score):
    low, high = hn.window_of(score)
    assert 100 * low >= 30 * score > 100 * (low - 1) and 100 * high <= 90 * score < 100 * (high + 1)
