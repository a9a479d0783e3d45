"""Code lengths against a plain recursion, and accuracy on held-out documents."""

import base64
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from barloom.llm import langid

WORDS = {"en": "the and of that with from this there which".split(), "de": "der die und nicht über für schön größe".split(), "el": "και το της είναι αυτό".split()}


def text_of(lang, rng, n=20):
    return " ".join(rng.choices(WORDS[lang], k=n))


def counts_of(texts):
    found = Counter()
    for lang, text in texts:
        for g in langid.grams(langid.letters(text)).tolist():
            found[lang, g] += 1
    return [(lang, g, n) for (lang, g), n in found.items()]


def slow_bits(texts, lang, text):
    """Every byte coded on its own from plain counts of contexts."""
    trees = [{} for _ in range(4)]
    for owner, t in texts:
        if owner == lang:
            b = b"   " + langid.letters(t)
            for i in range(3, len(b)):
                for order in range(4):
                    trees[order].setdefault(b[i - order : i], Counter())[b[i]] += 1

    def code(context, byte):
        tree = trees[len(context)].get(context)
        if tree is None:
            return code(context[1:], byte) if context else 8.0
        total, distinct = sum(tree.values()), len(tree)
        if byte in tree:
            return -math.log2(tree[byte] / (total + distinct))
        return -math.log2(distinct / (total + distinct)) + (code(context[1:], byte) if context else 8.0)

    b = b"   " + langid.letters(text)
    return sum(code(b[i - 3 : i], b[i]) for i in range(3, len(b)))


def test_code_lengths():
    rng = random.Random(1)
    texts = [(lang, text_of(lang, rng, 6)) for lang in WORDS for _ in range(3)]
    trees = langid.Trees(counts_of(texts))
    for text in ["the", "über die", "zzz qqq", "漢字", "Mixed the und και 12 !!", "x" * 300, text_of("el", rng)]:
        want = [slow_bits(texts, lang, text) for lang in trees.langs]
        assert np.allclose(trees.lengths(langid.letters(text)), want, rtol=1e-5)


@pytest.mark.parametrize("max_cells", [0, 3000, 200_000, 4_000_000])
def test_many_languages_are_coded_exactly(max_cells):
    rng = random.Random(2)
    words = {f"l{i:02}": ["".join(rng.choices([chr(c) for c in range(97 + i % 9, 110 + i % 9)] + ["é", "ψ", "漢"], k=rng.randint(1, 7))) for _ in range(30)] for i in range(50)}
    texts = [(lang, " ".join(rng.choices(own, k=40 if lang < "l40" else 8))) for lang, own in words.items()]
    trees = langid.Trees(counts_of(texts), max_cells)
    for text in [" ".join(rng.choices(words[lang], k=12)) for lang in ("l00", "l31", "l49")] + ["zzz", "漢字 ψé", "Ωmega x"]:
        form = langid.letters(text)
        want = [slow_bits(texts, lang, text) for lang in trees.langs]
        assert np.allclose(trees.lengths(form), want, rtol=1e-5)
        assert np.isclose(trees.switching(form[:60]), min(trees.lengths(form[:60])) + math.log2(50), rtol=1e-5)
        assert trees.predict(text)[0] == trees.langs[int(np.argmin(want))]


def test_table(spark):
    rng = random.Random(3)
    rows = [(i, text_of(lang, rng), lang, "s") for i, lang in enumerate(list(WORDS) * 40)]
    odd = [(500, None, "en", None), (501, "", "de", "s"), (502, "12 !! \n", None, "s"), (None, "the and of", None, "s"), (503, "und die", "de", "s"), (503, "und die", "de", "s"), (504, text_of("en", rng, 40_000), "en", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score string")
    got = langid.predict(docs, sample_rows=1000).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3 and by[500]["score"] == 0
    assert by[None]["lang_pred"] == "en" and by[None]["held_out"] is False and by[504]["lang_pred"] == "en"
    for i, _, lang, _ in rows:
        assert by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert by[i]["lang_pred"] == lang and 0 <= by[i]["score"] <= 1
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["lang_pred"] != "und"}


def test_other_texts_are_dropped(spark):
    rng = random.Random(5)
    clean = [(i, text_of(lang, rng), lang) for i, lang in enumerate(list(WORDS) * 60)]
    clean += [(900 + i, f"{text_of('en', rng)}. {text_of('el', rng)}!", lang) for i, lang in enumerate(["en", None, "el"])]
    clean += [(910, "und die", "de"), (911, "the and of", None)]
    gibberish = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(60)) for _ in range(6)]
    encoded = [base64.b64encode(rng.randbytes(300)).decode() for _ in range(6)]
    italian = "nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita"
    scripts = ["".join(chr(rng.randint(first, first + 30)) + " " * (rng.random() < 0.2) for _ in range(200)) for first in (0x4E00, 0x430)]
    planted = [(1000 + i, t, [None, "en", "de"][i % 3]) for i, t in enumerate([*gibberish, *encoded, italian, *scripts])]
    docs = spark.createDataFrame(clean + planted, "doc_id bigint, text string, lang string")
    scores = {r["doc_id"]: r["score"] for r in langid.predict(docs).collect()}
    assert min(scores[i] for i, _, _ in planted) > 0.5  # the score alone tells none of them
    assert sorted(r["doc_id"] for r in langid.keep_known(docs).collect()) == sorted(i for i, _, _ in clean)


def test_limits():
    assert langid.bits_a_byte([("a", 99, 10), ("b", 99, 6), ("b", 199, 1), ("b", 999, 1)]) == {"a": 4.0, "b": 4.0}
    assert langid.bits_a_byte([("a", 99, 5), ("a", 199, 5)]) == {"a": 10.0}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words here", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in langid.predict(docs).collect()] == [(1, False, "und", 0.0)]
    assert langid.predict(docs.limit(0)).collect() == []


@pytest.mark.parametrize("scale", ["0.01"])
def test_held_out_accuracy(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/sf{scale}/documents.parquet")
    got = langid.predict(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in got)
    assert len(got) > 100 and right >= 0.98 * len(got)
