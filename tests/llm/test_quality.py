"""Counts and verdicts against plain loops."""

import random
import re
from collections import Counter

from barloom.llm import quality
from barloom.llm.common import stage


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if at[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def slow_measures(text):
    n, chars, symbols, dup_lines, repeated = slow_counts(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
    return [1000 * chars // n, 1000 * chars // n, 1000 * symbols // n, 1000 * dup_lines // (lines + 4), 1000 * repeated // n]


def slow_bucket(v):
    shift = max(v.bit_length() - 7, 0)
    return v >> shift << shift


def slow_verdicts(rows, least):
    counts = [(key, slow_counts(text)) for key, text in rows]
    failed = [n < 50 or 100 * r > 50 * n for _, (n, _, _, _, r) in counts]
    measures = [None if f else slow_measures(text) for f, (_, text) in zip(failed, rows, strict=True)]

    def limits(chosen):
        out = []
        for i, m in enumerate(quality.MEASURES):
            values = sorted(slow_bucket(v[i]) for v in chosen)

            def at(percent):
                return next(v for k, v in enumerate(values) if 100 * (k + 1) >= percent * len(values))

            out.append(at(50) + m.side * (m.times * abs(at(50) - at(m.reach)) + m.slack))
        return out

    verdicts = []
    for (key, own), v in zip(counts, measures, strict=True):
        if v is None:
            verdicts.append((*own, True, False))
            continue
        for same in (lambda k: k == key, lambda k: k[0] == key[0], lambda k: True):
            group = [m for (k, _), m in zip(counts, measures, strict=True) if m is not None and same(k)]
            if len(group) >= least:
                break
        bad = any(m.side * (x - limit) > 0 for m, x, limit in zip(quality.MEASURES, v, limits(group), strict=True))
        verdicts.append((*own, False, not bad))
    return verdicts


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = [rng.choice(["the", "a", "gründe", "漢字", "word.", "x" * rng.randint(1, 9)]) + str(rng.randint(0, 400)) for _ in range(rng.randint(30, 160))]
        if i % 9 == 0:
            words = [w + rng.choice(["###", "*", "<>|"]) for w in words]
        if i % 7 == 0:
            words = words + words[: rng.randint(2, len(words))]
        if i % 11 == 0:
            words = ["y" * 40] * 3 + words
        text = " ".join(w + rng.choice(["", "", "\n", "\t", "\x0b\x0c", "\r", "\x1c", "\x85"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "b", None])))
    line = "a line that comes again and again\n"
    odd = [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, " \n\t", None, None), (3, "short", "fr", "z"), (3, "short", "fr", "z"), (None, line * 80, "en", "a")]
    odd += [(1003, " ".join(f"w{i}" for i in range(30_000)), "en", "a"), (1004, "one two", "en", "a"), (1005, "p q r " * 400, "en", "a"), (1006, "\n".join(["same line here", " ", "same line here", ""] + [f"k{i}" for i in range(60)]), "de", "b")]
    return rows + odd


def test_table(spark):
    data = corpus()
    docs = spark.createDataFrame([(s, i, t, lang, 5, True) for i, t, lang, s in data], "source string, doc_id bigint, text string, lang string, n_words int, kept boolean")
    for least in (40, 200):
        want = [(i, *v) for (i, *_), v in zip(data, slow_verdicts([((lang, s), t) for _, t, lang, s in data], least), strict=True)]
        assert sorted(map(tuple, quality.judge(docs, least_rows=least).collect()), key=repr) == sorted(want, key=repr)
        kept = quality.keep_good(docs, least_rows=least)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((w[0] for w in want if w[-1]), key=repr)


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def page(rng, symbols=0.0, repeats=0.0, lines=0.0, letters=5):
    """40 lines of six words: a share of words with a symbol, of lines with three words said before, of lines that are the first again, and the length of words."""
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=letters + rng.randint(-1, 1))) + "#" * (rng.random() < symbols)
    made = []
    for _ in range(40):
        if made and rng.random() < lines:
            made.append(made[0])
        else:
            old = rng.choice(made).split()[:3] if made and rng.random() < repeats else [word() for _ in range(3)]
            made.append(" ".join(old + [word() for _ in range(3)]))
    return "\n".join(made)


def test_limits_move_with_the_source(spark):
    """The same odd text is kept in a source where many are like it and rejected in one where none is, for every measure."""
    rng = random.Random(8)
    # a loose source varies up to the given value of its measure, the strict one beside it hardly varies
    kinds = (("letters", (5, 9), 9), ("letters", (12, 7), 6), ("symbols", (0, 0.3), 0.3), ("lines", (0, 0.45), 0.45), ("repeats", (0, 0.5), 0.85))
    rows, odd = [], {}
    for number, (kind, (low, high), value) in enumerate(kinds):
        base = {"letters": 12 if number == 1 else 5}
        for i in range(quality.LEAST_ROWS + 100):
            at = low + (high - low) * rng.random()
            rows.append((i, page(rng, **base), "en", f"strict {number}"))
            rows.append((i, page(rng, **{**base, kind: round(at) if kind == "letters" else at}), "en", f"loose {number}"))
        odd[number] = slow_measures(page(rng, **{**base, kind: value}))[number]
    measured = stage(quality.counted(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).drop("text"), "counts")
    found = {r["source"]: r["limits"] for r in quality.thresholds(stage(quality.sketches(measured), "sketches")).collect()}
    for number, m in enumerate(quality.MEASURES):
        loose, strict = found[f"loose {number}"][number], found[f"strict {number}"][number]
        assert m.side * (loose - strict) > 0, (number, loose, strict)
        assert m.side * (odd[number] - strict) > 0 >= m.side * (odd[number] - loose), (number, odd[number], loose, strict)


def test_repeated_lines_are_rejected(spark):
    rng = random.Random(12)
    rows = [(i, page(rng), "en", "a") for i in range(220)]
    line = "subscribe to our letter and never miss any of the news again"
    planted = []
    for i in range(20):
        lines = page(rng).split("\n")[:13]
        for _ in range(8):
            lines.insert(rng.randint(0, len(lines)), line)
        planted.append((1000 + i, "\n".join(lines), "en", "a"))
    got = quality.judge(spark.createDataFrame(rows + planted, "doc_id bigint, text string, lang string, source string")).where("not base_failed")
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert all(kept[i] for i in range(220)) and not any(kept[1000 + i] for i in range(20) if 1000 + i in kept)


def test_no_python_in_the_plan_and_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    df = quality.judge(docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.collect() == [] and "Python" not in plan and "Arrow" not in plan
