"""Pieces against the tokenizers library; packings against their invariants and the bound from the sum of lengths."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def slow_pieces(text, library):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    for piece, start in enumerate(range(0, len(ids), 2048)):
        part = ids[start : start + 2048]
        yield piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def check_places(rows):
    """No gaps, no overlaps, nothing over the capacity."""
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins)


def first_fit(lengths):
    """As many sequences as plain first-fit decreasing takes."""
    free = []
    for length in sorted(lengths, reverse=True):
        at = next((i for i, f in enumerate(free) if f >= length), len(free))
        if at == len(free):
            free.append(2048)
        free[at] -= length
    return len(free)


def test_words_like_the_library():
    library = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        codec = packing.WordCodec(f.read(), cache_words=40)
    random.seed(5)
    parts = ["a", "The", "don't", " ", " ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", "é", "é", "́", "Σ", "ΑΣ", "İ", "漢字", "🙂", "12", "...", "<|endoftext|>", "<|startoftext|>", " ", "̈́"]
    for _ in range(8000):
        text = "".join(random.choices(parts, k=random.randint(0, 14)))
        assert np.frombuffer(codec.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_table(spark):
    library = Tokenizer.from_file(PATH)
    random.seed(6)
    texts = [None, "", " \n", "one", "x " * 9000, "long" * 20_000] + [" ".join(random.choices(["and", "ther", "of", "ing"], k=random.randint(1, 900))) for _ in range(150)]
    rows = [(7 if i in (20, 21) else i, t, "x") for i, t in enumerate(texts)] + [(7, texts[20], "y"), (None, "no id", "z")] + [(1000 + i, "the same text", "c") for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    got = packing.pack(docs, PATH, keep_ids=True).collect()
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter((i, *p) for i, t, _ in rows for p in slow_pieces(t, library))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    assert check_places(got) <= first_fit([r["length"] for r in got])


def test_program():
    rng = random.Random(9)
    histogram = Counter(min(2048, int(rng.expovariate(1 / 500)) + 1) for _ in range(60_000))
    bins = packing.solve(dict(histogram))
    held = Counter()
    for many, content in bins:
        assert sum(length * n for length, n in content) <= 2048
        for length, n in content:
            held[length] += many * n
    assert held == histogram
    assert sum(many for many, _ in bins) <= 1.001 * -(-sum(length * n for length, n in histogram.items()) // 2048)


def size_of(bins, histogram, capacity=2048):
    """Number of bins, after checking that they hold the histogram and nothing overflows."""
    held = Counter()
    for many, content in bins:
        assert many > 0 and sum(length * n for length, n in content) <= capacity
        for length, n in content:
            held[length] += many * n
    assert held == Counter({k: n for k, n in histogram.items() if n})
    return sum(many for many, _ in bins)


#: Histograms by kind: lengths to draw from, draws, whether best-fit is known to leave bins that the program saves.
SHAPES = {
    "three lengths": ([501, 690, 800], 3000, True),
    "seven lengths": ([300, 411, 702, 555, 999, 1024, 130], 30_000, True),
    "narrow": (range(400, 501), 30_000, True),
    "quarters to halves": (range(513, 1001, 4), 30_000, True),
    "thirds": (range(560, 1101, 6), 6_000, False),
    "over halves": (range(1025, 2049, 8), 3_000, False),
    "few texts": (range(200, 901), 300, False),
    "short ones": (range(1, 60), 3_000, False),
    "one length": ([700], 1_000, False),
    "exact halves": ([1024, 512, 256], 4_000, False),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_bound_and_best_fit(shape):
    """Never over best-fit, never under the bound that the program proves, and fewer bins where best-fit leaves room."""
    lengths, draws, better = SHAPES[shape]
    rng = random.Random(shape)
    histogram = dict(Counter(rng.choice(lengths) for _ in range(draws)))
    solved = packing.program(histogram)
    size = size_of(packing.solve(histogram), histogram)
    plain = size_of(packing.best_fit(histogram, 2048), histogram)
    assert solved.least <= size <= plain
    assert size < plain or not better
    if len(lengths) < 10:
        assert size <= 1.01 * solved.bound + 1


def test_fractional_cover():
    """The weights cover every length, their contents fit, and their total is no less than the bound."""
    rng = random.Random(4)
    for kinds in (1, 2, 5, 60):
        histogram = {rng.randint(1, 2048): rng.randint(1, 400) for _ in range(kinds)}
        solved = packing.program(histogram)
        covered = Counter()
        for content, weight in solved.weights.items():
            assert sum(length * n for length, n in content) <= 2048
            for length, n in content:
                covered[length] += n * weight
        assert all(covered[length] >= n * (1 - 1e-9) for length, n in histogram.items())
        assert solved.bound <= solved.size * (1 + 1e-9)


def optimum(lengths, capacity):
    """Fewest bins, by trying all."""
    best = len(lengths)

    def place(at, free):
        nonlocal best
        if len(free) >= best:
            return
        if at == len(lengths):
            best = len(free)
            return
        for i in {f: i for i, f in enumerate(free) if f >= lengths[at]}.values():
            place(at + 1, [*free[:i], free[i] - lengths[at], *free[i + 1 :]])
        place(at + 1, [*free, capacity - lengths[at]])

    place(0, [])
    return best


def test_small_optima():
    rng = random.Random(12)
    for _ in range(60):
        capacity = rng.randint(10, 30)
        lengths = sorted((rng.randint(2, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        histogram = dict(Counter(lengths))
        best = optimum(lengths, capacity)
        assert packing.program(histogram, capacity).least <= best
        assert size_of(packing.solve(histogram, capacity), histogram, capacity) == best


def test_no_lengths():
    assert packing.solve({}) == [] and packing.solve({5: 0}) == []


def test_knapsack():
    rng = random.Random(2)
    for _ in range(30):
        items = [(rng.randint(1, 12), rng.random(), rng.randint(1, 3)) for _ in range(4)]
        content = packing.price([i[0] for i in items], [i[1] for i in items], [i[2] for i in items], 20)
        best = 0.0
        from itertools import product

        for take in product(*[range(i[2] + 1) for i in items]):
            if sum(n * i[0] for n, i in zip(take, items)) <= 20:
                best = max(best, sum(n * i[1] for n, i in zip(take, items)))
        by_length = {}
        for length, value, _ in items:
            by_length.setdefault(length, []).append(value)
        if len(by_length) == 4:
            assert sum(n * by_length[length][0] for length, n in content.items()) == pytest.approx(best)


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
