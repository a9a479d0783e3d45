"""Personal data: generators propose overlapping spans, boosted trees score them, a calibrated threshold selects."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import boosting
from barloom.llm.common import columns, map_batches

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Documents, on average, that the trees are fitted on, and the share of selected spans that must be right on rows kept from the fit.
SAMPLE_ROWS, PRECISION = 6000, 0.995
#: Most base spans, and other spans, of a document in the fit; spans that are scored at a time.
SAMPLE_SPANS, SCORED = 20, 20_000

#: fixed values: the base patterns. Digits are matched from their first digit on, so long runs are read once.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOOSE_MAIL = re.compile(r"[\w.+-]{1,64} ?(?:@|[\[(<{] ?(?:at|AT) ?[\])>}]) ?[\w-]{1,63}(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[\w-]{2,63}){1,4}")
_LOOSE_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9])+")
_DIGITS = re.compile(r"[0-9]+")
_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-./][01]?[0-9][-./][0-3]?[0-9]|[0-3]?[0-9][-./][01]?[0-9][-./](?:19|20)[0-9]{2})(?![0-9])")
_HINTS = [
    re.compile(p, re.IGNORECASE)
    for p in (r"mail|contact|write", r"\bip\b|host|server|addr", r"card|visa|credit|pay", r"phone|tel|call|fax|mobile|cell", r"\bid\b|order|isbn|ref|invoice|serial|no\.|version|\bv\b|total|date")
]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The spans of the base patterns, by kind."""
    found: list[list[tuple[int, int]]] = [[], [], [], []]
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            found[EMAIL].append((start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found[IP].append(m.span())
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found[CARD].append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= len(only_digits(m.group())) <= 15:
            found[PHONE].append(m.span())
    return found


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of all that may be personal data; spans overlap within and across kinds."""
    if "@" in text or "at" in text and ("[" in text or "(" in text or "<" in text or "{" in text):
        for m in _LOOSE_MAIL.finditer(text):
            yield EMAIL, *m.span()
    for m in _LOOSE_IP.finditer(text):
        yield IP, *m.span()
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= 7:
            yield from _numbers(text, *m.span())


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """From every group of digits of a run, with a + or ( before it, every end of a group with as many digits as a phone number or card has;
    the digits bound what a start proposes."""
    groups = [g.span() for g in _DIGITS.finditer(text, start, end)]
    for i, (at, _) in enumerate(groups):
        first = at - 1 if at > start and text[at - 1] in "+(" else at
        digits = 0
        for a, b in groups[i:]:
            digits += b - a
            if digits > 19:
                break
            if 7 <= digits <= 15:
                yield PHONE, first, b
            if digits >= 13:
                yield CARD, at, b


def _kind_of(char: str) -> int:
    return 0 if not char else 1 if char.isspace() else 2 if char.isdigit() else 3 if char.isalpha() else 4


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span, as numbers."""
    span, before, after = text[start:end], text[max(0, start - 30) : start], text[end : end + 20]
    groups = [len(g) for g in _DIGITS.findall(span)]
    digits = only_digits(span)
    parts = re.split(r"\.|\[\.\]|\(\.\)", span) if kind == IP else []
    tail = re.split(r"[^\w]+", span)[-1] if kind == EMAIL else ""
    return [
        *[float(kind == k) for k in range(4)],
        end - start,
        len(digits),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[-1] if groups else 0,
        *[span.count(c) for c in " -.(/"],
        span.startswith("+"),
        span.startswith("("),
        span.count("@"),
        kind == EMAIL and "@" not in span,
        len(tail),
        tail.isalpha(),
        kind == CARD and luhn(digits),
        kind == IP and all(p.isdigit() and int(p) <= 255 and str(int(p)) == p for p in parts),
        sum(c.isalpha() for c in span) / len(span),
        _kind_of(before[-1:]),
        _kind_of(after[:1]),
        before[-1:] in "=\"'#:.",
        after[:1] in ".-/" and after[1:2].isdigit(),
        span.count("(") - span.count(")"),
        before[-1:] in ".-/" and before[-2:-1].isdigit(),
        len(set(_DIGITS.sub("", span))),
        groups[0] if groups else 0,
        *[bool(h.search(before)) for h in _HINTS],
    ]


def _variants(kind: int, span: str, rng: random.Random) -> Iterator[tuple[str, list[str]]]:
    """Other ways to write a base span, and lookalikes: (text, the parts of it, in order, that are personal data)."""
    digits = only_digits(span)
    if kind == EMAIL:
        name, _, domain = span.partition("@")
        for written in (f"{name} (at) {domain}", f"{name}[at]{domain.replace('.', '[dot]')}", f"{name} @ {domain}"):
            yield written, [written]
        yield f"@{name} @{domain.split('.')[0]}", []
        yield f"{name}@{rng.randint(10, 99)}.{rng.randint(10, 99)}", []
    elif kind == IP:
        a, b, c, d = span.split(".")
        yield f"{a}[.]{b}[.]{c}[.]{d}", [f"{a}[.]{b}[.]{c}[.]{d}"]
        yield f"{a}.{b}.{c}.{256 + int(d)}", []
        yield f"v{a}.{b}.{c}.{d}.{rng.randint(0, 9)}", []
        yield f"0{a}.0{b}.00.{d}", []
    elif kind == CARD:
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        spaced, dashed = (sep.join((digits[:4], digits[4:8], digits[8:12], digits[12:])) for sep in " -")
        yield f"{digits} {digits}", [digits, digits]
        yield f"{dashed} {rng.randint(100, 999)}", [dashed]
        yield f"{spaced} {rng.randint(100, 999)}", [spaced]
        yield f"{spaced} {rng.randint(1, 12):02}/{rng.randint(24, 35)}", [spaced]
        yield f"{digits} {rng.randint(1, 12):02}/{rng.randint(24, 35)} {rng.randint(100, 999)}", [digits]
        yield wrong, []
        yield f"{wrong[:4]} {wrong[4:8]} {wrong[8:12]} {wrong[12:]}", []
        yield f"{wrong} {digits[::-1]}7", []
    else:
        local = digits[-10:]
        round_, dashed, dotted = f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}"
        date = f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        other = f"{local[:6]}{rng.randint(1000, 9999)}"
        round_other, dashed_other = f"({other[:3]}) {other[3:6]}-{other[6:]}", f"{other[:3]}-{other[3:6]}-{other[6:]}"
        yield round_, [round_]
        yield dashed, [dashed]
        yield f"tel {dotted}", [dotted]
        yield f"{round_} {round_other}", [round_, round_other]
        yield f"{dashed} {dashed_other}", [dashed, dashed_other]
        yield f"{dashed} {date}", [dashed]
        yield f"{date} {round_}", [round_]
        yield f"order {local}", []
        yield f"{date} 10.2{local[5]}", []
        yield f"20{local[:2]}-0{local[3]}-1{local[4]} 10.2{local[5]}", []
        yield f"isbn 978-{local[:1]}-{local[1:5]}-{local[5:9]}-{local[9:]}", []
        yield local + digits[:2], []


def _joined(by_kind: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """The spans of all kinds, sorted, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(span for spans in by_kind for span in spans):
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _overlaps(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether a span touches one of sorted spans that do not overlap each other."""
    at = bisect_left(spans, (end, 0)) - 1
    return at >= 0 and spans[at][1] > start


def impossible(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a proposal cannot be personal data of its kind, whatever the text is about."""
    span = text[start:end]
    if kind == EMAIL:
        last = re.split(r"[^\w]+", span)[-1]
        return not last.isalpha() or len(last) < 2
    if kind == IP:
        return any(int(p) > 255 or str(int(p)) != p for p in _DIGITS.findall(span))
    if text[start - 1 : start].isalnum() or text[end : end + 1].isalnum():
        return True  # part of a word
    if kind == CARD:
        return not luhn(only_digits(span))
    return span.count("(") != span.count(")") or bool(_DATE.search(span)) or len(_DIGITS.findall(span)) > 7


def examples(text: str) -> Iterator[tuple[list[float], int, int, int, int]]:
    """Labelled spans of a text, (features, label, group, start, end); spans of a group are proposed for the same text.

    Base spans and their other ways of writing are personal data; lookalikes and other cuts of either are not. Of what else the generators
    propose away from base spans, the impossible is not; the rest may be personal data that the base patterns miss, and has no label.
    """
    base = base_spans(text)
    every = _joined(base)
    rng = random.Random(zlib.crc32(text.encode()))
    named = [(kind, *span) for kind, spans in enumerate(base) for span in spans]
    group = 0
    for kind, start, end in named if len(named) <= SAMPLE_SPANS else sorted(rng.sample(named, SAMPLE_SPANS)):
        group += 1
        yield features(text, kind, start, end), 1, group, start, end
        before, after = text[max(0, start - 60) : start], text[end : end + 60]
        for written, parts in _variants(kind, text[start:end], rng):
            group += 1
            changed, s, e = before + written + after, len(before), len(before) + len(written)
            true, at = set(), s
            for part in parts:
                a = changed.index(part, at)
                at = a + len(part)
                true.add((kind, a, at))
            for k, a, b in proposals(changed):
                if a < e and s < b:
                    yield features(changed, k, a, b), int((k, a, b) in true), group, a, b
    group += 1
    for k, a, b in _sampled((p for p in proposals(text) if not _overlaps(p[1], p[2], every) and impossible(text, *p)), rng):
        yield features(text, k, a, b), 0, group, a, b


def _sampled(spans: Iterator[tuple[int, int, int]], rng: random.Random) -> list[tuple[int, int, int]]:
    """``SAMPLE_SPANS`` of the spans, each as likely as another."""
    held: list[tuple[int, int, int]] = []
    for i, span in enumerate(spans):
        if i < SAMPLE_SPANS:
            held.append(span)
        elif (at := rng.randint(0, i)) < SAMPLE_SPANS:
            held[at] = span
    return held


def fit(docs: DataFrame, id_col: str, text_col: str, sample_rows: int = SAMPLE_ROWS, precision: float = PRECISION) -> tuple[boosting.Booster, np.ndarray]:
    """Trees fitted on the labelled spans of a hash sample of ``sample_rows`` documents on average, and the calibrated threshold of each kind.

    A third of the sampled documents is kept from the fit; on it, a threshold is the least score with the asked precision, over the spans
    of the kind that stay when of overlapping ones the best is taken. A kind without such spans gets none added.
    """
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`"), F.lit(3)).alias("h"), F.col(f"`{text_col}`").alias("text"))
    rate = min(1.0, sample_rows / max(1, docs.count()))
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) <= int(rate * (1 << 20))).where("text is not null")
    names = ["h", "y", "g", "s", "e"]

    def run(batches):
        for batch in batches:
            made = [(h, y, g, s, e, f) for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for f, y, g, s, e in examples(text)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([m[i] for m in made], pa.int64()) for i in range(5)], pa.array([[float(v) for v in m[5]] for m in made], pa.list_(pa.float64()))], [*names, "x"]
            )

    found = map_batches(sample, run, "h bigint, y bigint, g bigint, s bigint, e bigint, x array<double>").toArrow()
    if not found.num_rows:
        return boosting.Booster(-20.0, 0.0, []), np.full(len(KINDS), 1.01)
    h, y, g, s, e = (found[n].to_numpy() for n in names)
    x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(h), -1)
    order = np.lexsort((*x.T, y, e, s, g, h))  # the same rows in the same order, however they arrive
    h, y, g, s, e, x = h[order], y[order].astype(float), g[order], s[order], e[order], x[order]
    kept = h % 3 == 2
    model = boosting.fit(x[~kept], y[~kept])
    p = model.predict(x[kept])
    best = _best(p, h[kept], g[kept], s[kept], e[kept])
    p, y, kind = p[best], y[kept][best], x[kept][best, : len(KINDS)].argmax(axis=1)  # the features begin with the kind
    return model, np.array([boosting.threshold(p[kind == k], y[kind == k], precision) for k in range(len(KINDS))])


def _best(scores: np.ndarray, h: np.ndarray, g: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The spans that overlap none of a better score in their group, as :func:`chosen` takes them."""
    taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
    out = []
    for i in np.lexsort((s, s - e, -scores)).tolist():
        own = taken.setdefault((h[i], g[i]), [])
        if not _overlaps(s[i], e[i], own):
            insort(own, (s[i], e[i]))
            out.append(i)
    return np.array(out, np.int64)


def chosen(base: list[list[tuple[int, int]]], spans: list[tuple[int, int, int]], scores: list[float]) -> list[list[tuple[int, int]]]:
    """Base spans plus the proposals, the best first, that overlap none before them."""
    out = [list(s) for s in base]
    taken = _joined(base)
    for i in sorted(range(len(spans)), key=lambda i: (-scores[i], spans[i][1] - spans[i][2], spans[i])):
        kind, start, end = spans[i]
        if not _overlaps(start, end, taken):
            out[kind].append((start, end))
            insort(taken, (start, end))
    return [sorted(s) for s in out]


def _named(by_kind: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, spans in enumerate(by_kind) for s, e in spans)


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, precision: float = PRECISION, redacted: bool = False
) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row; counts and hash are of the base spans.

    Spans are kind:start:end in code points, end exclusive, by kind and start: the base spans and those that the trees add away from
    them. With ``redacted`` a last column has the text with every span replaced by its kind in brackets.

    A null text counts as empty and has no spans. Repeated rows and null ids each return their row. An empty table gives no rows.
    Whole texts are read; other columns are not.
    """
    model, limits = fit(docs, id_col, text_col, sample_rows, precision)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", *(["redacted"] if redacted else [])]
    schema = ", ".join([f"`{id_col}` {kind}", *[f"{n} bigint" for n in names[1:5]], *[f"{n} string" for n in names[5:]]])

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            held: dict[int, list[tuple[tuple[int, int, int], float]]] = {}
            near = ((i, span) for i, t in enumerate(texts) for taken in [_joined(base[i])] for span in proposals(t) if not _overlaps(span[1], span[2], taken))
            while part := list(islice(near, SCORED)):  # what is under the threshold is not held
                scores = model.predict(np.array([features(texts[i], *span) for i, span in part], float))
                for at in np.flatnonzero(scores >= limits[[span[0] for _, span in part]]).tolist():
                    held.setdefault(part[at][0], []).append((part[at][1], float(scores[at])))
            out = []
            for i, text in enumerate(texts):
                every = chosen(base[i], *map(list, zip(*held[i], strict=True))) if i in held else base[i]
                row = [*map(len, base[i]), hashlib.sha256(_named(base[i]).encode()).hexdigest(), _named(every)]
                if redacted:
                    clean, end = [], 0
                    for s, e, k in sorted((s, e, k) for k, own in enumerate(every) for s, e in own):
                        if s >= end:
                            clean += [text[end:s], f"[{KINDS[k]}]"]
                        end = max(end, e)
                    row.append("".join(clean) + text[end:])
                out.append(row)
            types = [pa.int64()] * 4 + [pa.string()] * (len(names) - 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in out], t) for k, t in enumerate(types)]], names)

    return map_batches(columns(docs, id_col, text_col), run, schema)
