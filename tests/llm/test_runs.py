"""Periodic runs against trying every period; the grammar against its text."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from barloom.llm import queries, runs


def slow(words, least=12):
    """Every maximal stretch for every period; of one stretch the smallest."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(least, 2 * q):
                out.setdefault((at, end + q), q)
            at = end + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def texts():
    rng = random.Random(11)
    yield from ([], [1], [1] * 11, [1] * 12, [1] * 13, [1, 2] * 6, [1, 2] * 500, [1] * 1000, list(range(6)) * 2, list(range(30)) * 2, list(range(7)) * 30 + [1, 2, 3])
    for kinds in (1, 2, 2, 3, 5, 50):
        yield from ([rng.randrange(kinds) for _ in range(rng.randrange(400))] for _ in range(6))
    fib = [[1], [1, 2]]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    thue = [0]
    while len(thue) < 1024:
        thue += [1 - x for x in thue]
    yield thue
    for _ in range(30):
        out = []
        while len(out) < 600:
            period = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
            out += (period * rng.randrange(1, 9))[: rng.randrange(1, 200)] if rng.random() < 0.7 else [rng.randrange(1000) for _ in range(20)]
        yield out


def test_runs_of_many_texts_at_once():
    held = list(texts())
    flat = np.array([w for t in held for w in t], np.int64)
    part = np.repeat(np.arange(len(held)), [len(t) for t in held])
    want, at = [], 0
    for t in held:
        want += [(s + at, e + at, q) for s, e, q in slow(t)]
        at += len(t)
    assert len(want) > 150 and runs.runs_of(flat, part) == sorted(want)


def test_wrong_hashes_are_noticed(monkeypatch):
    """With a first hash in which all words agree the extents are too long; the next is right."""
    rng = random.Random(3)
    text = np.array([rng.randrange(2) for _ in range(300)], np.int64)
    real, seeds = runs.Extents, []

    class Poor(real):
        def __init__(self, ids, seed):
            seeds.append(seed)
            super().__init__(ids, seed)

        def _same(self, a, b, length):
            return np.ones(len(a), bool) if seeds[-1] == 0 else super()._same(a, b, length)

    monkeypatch.setattr(runs, "Extents", Poor)
    assert runs.runs_of(text, np.zeros(len(text), np.int64)) == slow(text.tolist()) and seeds == [0, 1]


def test_grammar():
    for text in texts():
        rules, rest, base = runs.re_pair(list(text))

        def expand(s):
            return [s] if s < base else [x for c in rules[s - base] for x in expand(c)]

        assert [w for s in rest for w in expand(s)] == list(text)
        pairs = list(zip(rest, rest[1:], strict=False))
        assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)


def test_long_text_stays_near_linear():
    rng = random.Random(1)
    text = np.array(([5] * 60_000) + [rng.randrange(9) for _ in range(20_000)] + list(range(100, 400)) * 150, np.int64)
    found = runs.runs_of(text, np.zeros(len(text), np.int64))
    assert (0, 60_000, 1) in found and (80_000, 125_000, 300) in found


def rows():
    rng = random.Random(5)
    vocabulary = ["a", "b", "ça", "日本", "x" * 30, "-"]
    out = [(i, " ".join(rng.choice(vocabulary[: rng.randrange(1, 7)]) for _ in range(rng.randrange(120)))) for i in range(120)]
    return out + [(200, None), (201, ""), (202, " \n\t"), (203, "a\tb\x0bc\x0cd\re\nf " * 40), (204, "a b" * 9), (None, "w " * 40), (205, "a\x1cb " * 14), (3, out[3][1])]


def contract(i, text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(i).encode())
    if i is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    found = slow(words)
    gone = {k for s, e, q in found for k in range(s + q, e)}
    best = max(found, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    told = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (i, len(found), *told, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


@pytest.mark.parametrize("chunk", [500_000, 50])
def test_query(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(runs, "CHUNK_WORDS", chunk)
    spark.createDataFrame([(t, i, "x", 0) for i, t in rows()], "text string, doc_id bigint, runs string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    fields = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.select(*fields).collect()), key=repr) == sorted((contract(i, t) for i, t in rows()), key=repr)


def test_operator_on_its_own(spark):
    docs = spark.createDataFrame([(1, "so " + "it goes on " * 6 + "and ends")], "id int, body string")
    (row,) = runs.detect(docs, "id", "body").collect()
    assert [tuple(r) for r in row.runs] == [(1, 18, 3)] and row.collapsed == "so it goes on and ends" and row.n_words == 21


def test_no_rows(spark):
    assert runs.detect(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
