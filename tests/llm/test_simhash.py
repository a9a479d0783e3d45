"""Fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from barloom.llm import simhash


def slow_print(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_sets(prints):
    """The least member of each member's component, over all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def slow_components(rows):
    prints = [(i, slow_print(t)) for i, t in rows]
    sets = slow_sets([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[sets[p]] = min(i, least.get(sets[p], i))
    return sorted(((i, f"{p:016x}", least.get(sets[p])) for i, p in prints), key=repr)


WEIRD = [None, "", " \t\n", "one", "One two", "ONE TWO", "Ünï cödé\x1cword word", "a\x0bb\x0cc\rd", "x " * 5000, "y" * 100000]


def corpus(seed, n=120):
    random.seed(seed)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(random.choices(words, k=random.randint(3, 200))) for _ in range(n // 4)]
    out = []
    for i in range(n):
        t = random.choice(base).split()
        for _ in range(random.randint(0, 3)):
            t[random.randrange(len(t))] = random.choice(words)
        out.append((i, " ".join(t)))
    return out + [(1000 + i, t) for i, t in enumerate(WEIRD)] + [(3, "again here"), (3, "again here"), (None, "no id"), (None, None)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fingerprints():
    for _, t in corpus(1):
        assert simhash.fingerprint(t) == slow_print(t)


@pytest.mark.parametrize("bucket", [16_384, 3])
def test_components(spark, bucket):
    data = corpus(2)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in data], "doc_id bigint, text string, fp int, key string")
    assert rows_of(simhash.near_copies(docs, bucket=bucket)) == slow_components(data)


@pytest.mark.parametrize("pairs", [32_768, 2])
def test_sets_in_runs(pairs):
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 2**9, 300).astype(np.uint64) << np.uint64(20)
    run = np.sort(rng.integers(0, 4, 300))
    parent = simhash.sets_in_runs(run, prints, pairs=pairs)
    for r in range(4):
        at = np.flatnonzero(run == r)
        want = slow_sets([int(prints[i]) for i in at])
        got = {}
        for i in at:
            got.setdefault(int(parent[i]), set()).add(want[int(prints[i])])
        assert all(len(s) == 1 for s in got.values()) and len(got) == len(set(want.values()))


def test_hot_bucket_is_indexed_again(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) & 0xFFFF0FFF00FFF0FF for _ in range(3)}
    for p in list(prints):
        for _ in range(150):
            prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(20)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    from barloom.llm.components import roots

    want = slow_sets(prints)
    for bucket in (16_384, 10):
        star = {n % (1 << 64): r % (1 << 64) for n, r in roots(simhash.links(spark.createDataFrame(signed, "fp bigint"), bucket)).collect()}
        sets, slow = {}, {}
        for p in prints:
            sets.setdefault(star.get(p, p), set()).add(p)
            slow.setdefault(want[p], set()).add(p)
        assert sorted(map(sorted, sets.values())) == sorted(map(sorted, slow.values()))


def test_one_of_each(spark):
    data = corpus(4)
    docs = spark.createDataFrame([(t, i, "n", 1) for i, t in data], "text string, doc_id bigint, fp string, n int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(i, t) for t, i, _, _ in kept.collect()]
    want = slow_components(data)
    assert len(got) == len(set(slow_sets([int(f, 16) for _, f, _ in want]).values()))
    named = {c for _, _, c in want if c is not None}
    assert {i for i, _ in got if i is not None} == named


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_copies(docs).collect() == [] and simhash.one_of_each(docs).collect() == []
