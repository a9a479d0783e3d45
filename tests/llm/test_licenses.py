"""Places, labels and scores against brute force over all blocks and templates."""

import functools
import math
import random
import re

from barloom.llm import licenses


def slow_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@functools.cache
def common_in_order(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def slow(text):
    found = slow_words(text)
    at, base, labels, score = [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(found)) if found[i : i + len(p)] == p]
        at += own
        base |= {label} if own else set()
    for label, t in licenses.TEMPLATES.items():
        wanted = slow_words(t)
        kept = len(wanted) if len(wanted) < 10 else math.ceil(0.8 * len(wanted) - 1e-9)
        span, common = len(wanted) + len(wanted) // 4, set(wanted)
        for start in range(len(found)):
            if found[start] in common:
                both = common_in_order(tuple(found[start : start + span]), tuple(wanted))
                if both >= kept:
                    labels.add(label)
                    score = max(score, both / len(wanted))
    return len(found), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else score


def corpus():
    rng = random.Random(5)
    pool = ["the", "Under", "license", "licensed", "version", "software", "all", "rights", "cc", "by", "nc", "mit", "word", "née", "漢字", "2", "0", "public", "general"]
    rows = []
    for i in range(300):
        parts = rng.choices(pool, k=rng.randint(0, 120))
        if i % 3 == 0:
            t = rng.choice(list(licenses.TEMPLATES.values())).split()
            for _ in range(rng.randint(0, 3)):
                t.pop(rng.randrange(len(t)))
            parts[rng.randint(0, len(parts)) : 0] = t
        if i % 5 == 0:
            parts.append(rng.choice(["CC-BY cc by", "GENERAL-Public\nLicense", "All rights\x00reserved.", "cc by cc by cc by"]))
        rows.append((i, rng.choice([" ", "\n", "-", "\x7f "]).join(parts)))
    odd = [(400, None), (401, ""), (402, "--- \n"), (3, "All rights reserved"), (3, "All rights reserved"), (None, "released under the mit license")]
    return rows + odd + [(403, "filler " * 40_000 + licenses.TEMPLATES["bsd"] + " cc by" * 3)]


def test_table(spark):
    data = corpus()
    docs = spark.createDataFrame([(t, i, "x", 1) for i, t in data], "text string, doc_id bigint, label string, row int")
    got = [(*r[:-1], round(r[-1], 9)) for r in licenses.scan(docs).collect()]
    want = [(i, *s[:-1], round(s[-1], 9)) for i, t in data for s in [slow(t)]]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {w[6] for w in want} >= {"apache-2.0", "", "mit"}


def test_no_rows(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_no_label_from_common_words(spark):
    told = {
        "released under the GNU General Public License": "gpl",
        "released under the Apache License version 2.0": "",
        "licensed under the MIT license version 2.0": "",
        "The prisoners had all been released under the new license rules": "",
        "All prisoners have rights which the court reserved": "",
        "Licensed under the CC BY 4.0": "cc-by",
        "license mit the under released": "",
    }
    texts = [*told, *licenses.TEMPLATES.values()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r.labels for r in licenses.scan(docs).orderBy("doc_id").collect()]
    assert got[: len(told)] == list(told.values())
    for label, labels in zip(licenses.TEMPLATES, got[len(told) :], strict=True):
        assert label in labels.split(",")


def test_a_word_may_be_missing_or_added_in_long_templates(spark):
    text = licenses.TEMPLATES["bsd"].split()
    odd = [" ".join(text[:5] + ["the", "new"] + text[5:]), " ".join(text[:4] + text[7:]), " ".join(reversed(text)), " ".join(text[:12])]
    got = [r.labels for r in licenses.scan(spark.createDataFrame(list(enumerate(odd)), "doc_id int, text string")).orderBy("doc_id").collect()]
    assert got == ["bsd", "bsd", "", ""]
