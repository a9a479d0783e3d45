"""Base spans against the plain patterns; added spans on planted ones; the trees on data they have not seen."""

import hashlib
import random
import re

import numpy as np

from barloom.llm import boosting, pii

PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_base(text):
    out = []
    for k, p in enumerate(PLAIN):
        own = []
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if (True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 13 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15)[k]:
                own.append(m.span())
        out.append(own)
    return out


PIECES = ["a", "Z9", "@", "@", ".", ".", "-", "+", "+1", " ", "(", ")", "1", "22", "255", "256", "4539578763621486", "4539 5787 6362 1486", "x.y@mail.example.com", "+1 (212) 555-0100", "10.0.0.1", "é", "٣", "漢", "\n", "001"]


def texts():
    rng = random.Random(6)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(4000)]


def test_base_spans():
    for t in texts():
        assert pii.base_spans(t) == slow_base(t), t
    for t in ("1" * 200_000, "a" * 200_000 + "@", "+1 " * 50_000, "1.1." * 50_000, "a@b.c " * 20_000):
        pii.base_spans(t)


def document(rng, i):
    words = " ".join(rng.choices(["the", "and", "ther", "ing", "of"], k=40))
    card = "4" + "".join(rng.choices("0123456789", k=14))
    card = next(card + c for c in "0123456789" if pii.luhn(card + c))
    extra = [f"mail x{i}@mail.example.com now", f"at {i % 256}.12.0.{i % 200} there", f"pay {card} please", f"call +1 (212) 555-{1000 + i % 9000} ok", "", f"order {card[:-1]}{(int(card[-1]) + 3) % 10} sent"][i % 6]
    return f"{words} {extra} {words}"


def test_table(spark):
    rng = random.Random(1)
    rows = [(i, document(rng, i)) for i in range(1500)]
    planted = "the and of 4539578763621486 4485275742308327 ther ing"
    odd = [(1700, None), (1701, ""), (1702, planted), (3, rows[3][1]), (3, rows[3][1]), (None, rows[1][1]), (1703, "word " * 40_000 + "x1@mail.example.com")]
    docs = spark.createDataFrame([(t, i, 0, "s") for i, t in rows + odd], "text string, doc_id bigint, n_ip int, spans string")
    got = pii.find(docs, redacted=True).collect()
    assert len(got) == len(rows) + len(odd)
    texts_of = {i: t for i, t in rows + odd}
    for r in got:
        base = slow_base(texts_of[r["doc_id"]])
        named = [f"{pii.KINDS[k]}:{s}:{e}" for k, own in enumerate(base) for s, e in own]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(map(len, base))
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r["spans"].split(",")) | ({""} if not named else set())
        if r["doc_id"] != 1702 and r["doc_id"] is not None:
            assert r["spans"] == ",".join(named), r  # nothing added to documents without other spans
    by = {r["doc_id"]: r for r in got}
    assert by[1702]["spans"] == "card:11:27,card:28:44" and by[1702]["n_card"] == 0
    assert by[1702]["redacted"] == "the and of [card] [card] ther ing" and by[1700]["redacted"] == ""



NUMBERS = [
    ("call (415) 555-2671 (415) 555-2672 today", ["phone:5:19", "phone:20:34"]),
    ("tel 415-555-2671 2024-01-05 ok", ["phone:4:16"]),
    ("pay 4111 1111 1111 1111 123 now", ["card:4:23"]),
    ("card 4111 1111 1111 1111 12/27 now", ["card:5:24"]),
]


def test_number_proposals():
    for text, want in NUMBERS:
        assert set(want) <= {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.proposals(text)}, text
    for text in ("1 2 3 4 5 6 7 8 9 0 " * 5000, "1" * 100_000, "(1) " * 20_000, "12-34/" * 20_000):
        found = list(pii.proposals(text))
        assert len(found) == len(set(found)) <= 20 * len(text)


def test_numbers_are_found(spark):
    rng = random.Random(8)
    rows = [(i, document(rng, i)) for i in range(1500)]
    planted = [(2000 + i, f"the and of {text} ther ing", want) for i, (text, want) in enumerate(NUMBERS)]
    docs = spark.createDataFrame(rows + [p[:2] for p in planted], "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs).where("doc_id >= 2000").collect()}
    for i, text, want in planted:
        moved = [f"{k}:{int(s) + 11}:{int(e) + 11}" for k, s, e in (w.split(":") for w in want)]
        assert got[i].split(",") == moved, (text, got[i])


FORMS = [
    "call (415) 555-{} ok",
    "mail bob{} (at) mail.example.com now",
    "host 10[.]12[.]7[.]{} there",
]


def test_natural_finds_have_no_label():
    for form in FORMS:
        text = f"the and of {form.format(255 if '[.]' in form else 2671)} ther ing"
        assert list(pii.proposals(text)) and not list(pii.examples(text)), text
    for text in ("id 4539578763621487 sent", "host 10.12.7.256 up", "on 2024-01-05 10.25", "x (at) 12.34"):
        found = list(pii.examples(text))
        assert {y for _, y, *_ in found} <= {0} and bool(found) == any(pii.impossible(text, *p) for p in pii.proposals(text)), text


def test_many_natural_finds(spark):
    rng = random.Random(9)
    rows = [(i, document(rng, i)) for i in range(1500)]
    forms = [(3000 + i, f"the and of {FORMS[i % 3].format(100 + i % 100 if i % 3 == 2 else 1000 + i)} ther ing") for i in range(600)]
    docs = spark.createDataFrame(rows + forms, "doc_id bigint, text string")
    got = pii.find(docs).where("doc_id >= 3000").collect()
    kinds = ("phone", "email", "ip")
    for k in range(3):
        own = [r["spans"] for r in got if (r["doc_id"] - 3000) % 3 == k]
        assert sum(s.startswith(kinds[k]) and "," not in s for s in own) >= 0.95 * len(own), (kinds[k], own[:3])


def test_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 2] * x[:, 3] > 0.3)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    p = model.predict(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.9
    limit = boosting.threshold(p, y[2000:], 0.97)
    assert y[2000:][p >= limit].mean() >= 0.97
    assert boosting.fit(x[:5], np.zeros(5)).predict(x[:2]).max() < 0.2 and boosting.threshold(np.zeros(0), np.zeros(0), 0.9) > 1


def test_no_rows(spark):
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
