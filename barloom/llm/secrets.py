"""Secret scans through an inverted index of trigrams; DataFrame and SQL functions only."""

from __future__ import annotations

from re import _constants as node
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import columns, stage


class Rule(NamedTuple):
    """A match counts when its ``group`` has at least ``least`` characters; a failing match is dropped and not tried again."""

    kind: str
    pattern: str
    group: int
    least: int


#: fixed values: kinds, patterns and least lengths of the base rules
BASE = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # runs of hex digits are matched as wholes, so shorter ones need not be matched to be dropped
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: fixed values: well-known shapes of keys
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", 0, 1),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
RULES = BASE + MORE

#: A Boolean query in disjunctive form: a text can match only if it has all trigrams of one of the sets. None: any text can.
Query = frozenset[frozenset[str]] | None
_MOST_STRINGS, _MOST_SETS = 32, 64


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    joined = frozenset(x | y for x in a for y in b)
    return joined if len(joined) <= _MOST_SETS else a


def _either(parts: list[Query]) -> Query:
    if any(p is None for p in parts):
        return None
    joined = frozenset().union(*parts)
    return joined if len(joined) <= _MOST_SETS else None


def _of_strings(strings: set[str]) -> Query:
    if any(len(s) < 3 for s in strings):
        return None
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _letters(items) -> set[str] | None:
    """The characters of a small class, lower-cased; None for a large or negated one."""
    found: set[str] = set()
    for kind, value in items:
        if kind is node.LITERAL:
            found.add(chr(value).lower())
        elif kind is node.RANGE and value[1] - value[0] < 5:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 6 else None


def _analyse(sequence) -> tuple[set[str] | None, Query]:
    """(all strings the part can match, or None where there are too many; the trigrams that a match needs)."""
    run: set[str] = {""}
    needed: Query = None
    whole = True
    for kind, value in sequence:
        strings, query = None, None
        if kind is node.LITERAL:
            strings = {chr(value).lower()}
        elif kind is node.IN:
            strings = _letters(value)
        elif kind is node.SUBPATTERN:
            strings, query = _analyse(value[3])
        elif kind is node.BRANCH:
            parts = [_analyse(p) for p in value[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*[s for s, _ in parts])
            else:
                query = _either([q if s is None else _of_strings(s) for s, q in parts])
        elif kind in (node.MAX_REPEAT, node.MIN_REPEAT):
            low, high, part = value
            inner, inner_query = _analyse(part)
            if inner is not None and low == high and low <= 8 and len(inner) ** low <= _MOST_STRINGS:
                strings = {""}
                for _ in range(low):
                    strings = {a + b for a in strings for b in inner}
            elif inner is not None and (low, high) == (0, 1):
                strings = {"", *inner}
            elif low >= 1:
                query = _of_strings(inner) if inner is not None else inner_query
        elif kind is node.AT:
            strings = {""}
        if strings is not None and len(strings) * len(run) <= _MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        needed, run = _both(needed, _of_strings(run)), {""}
        if strings is not None:
            run = strings if len(strings) <= _MOST_STRINGS else {""}
        else:
            whole = False
            needed = _both(needed, query)
            continue
        whole = False
    if whole:
        return run, _of_strings(run)
    return None, _both(needed, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The Boolean query of lower-case trigrams that every match of the pattern satisfies."""
    strings, query = _analyse(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trigrams_of(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for part in trigram_query(r.pattern) or () for t in part})


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index (trigram, id): every document whose lower-cased text has the trigram, for all trigrams that a rule needs."""
    folded = columns(docs, id_col, text_col).toDF("id", "text").select("id", F.lower("text").alias("folded"))
    found = [F.when(F.contains("folded", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams_of(rules))]
    numbers = F.array_compact(F.array(*found)) if found else F.array().cast("array<int>")
    return folded.select(F.explode(numbers).alias("trigram"), "id")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, rules): the numbers of the rules, as bits, whose query the document's postings satisfy.

    Postings intersect as bits, so that each task merges what it has before the shuffle.
    """
    known = trigrams_of(rules)
    words = [F.bit_or(F.when(F.col("trigram").between(w, w + 62), F.expr(f"shiftleft(1L, trigram - {w})")).otherwise(0)).alias(f"w{w}") for w in range(0, len(known), 63)]
    if not words:
        return index.select("id", F.lit(0).cast("bigint").alias("rules")).limit(0)
    bits = index.groupBy("id").agg(*words)

    def has(part: frozenset[str]) -> str:
        masks: dict[int, int] = {}
        for t in part:
            at = known.index(t)
            masks[at // 63 * 63] = masks.get(at // 63 * 63, 0) | 1 << at % 63
        return " and ".join(f"(w{w} & {m}L) = {m}L" for w, m in sorted(masks.items()))

    fits = []
    for number, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query is not None:
            either = " or ".join(f"({has(part)})" for part in sorted(query, key=sorted))
            fits.append(f"case when {either} then {1 << number}L else 0L end")
    return bits.selectExpr("id", f"{' + '.join(fits)} as rules").where("rules != 0")


def _spans(rules: tuple[Rule, ...], text: str, fits: str) -> str:
    """SQL for the sorted array of spans (s, k, e). Positions are sums of the lengths of what lies between the matches."""
    parts = []
    for number, rule in enumerate(rules):
        p = _literal(rule.pattern)
        guard = f"({fits} & {1 << number}L) != 0" if trigram_query(rule.pattern) is not None else f"{text} rlike {p}"
        parts.append(
            f"""case when {guard} then aggregate(
              zip_with(split({text}, {p}, -1),
                zip_with(regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {rule.group}), (a, b) -> named_struct('m', length(a), 'g', length(b))),
                (p, x) -> named_struct('p', length(p), 'm', x.m, 'g', x.g)),
              cast(named_struct('at', 0, 'out', array()) as struct<at: int, out: array<struct<s: int, k: int, e: int>>>),
              (acc, x) -> named_struct('at', acc.at + x.p + coalesce(x.m, 0), 'out',
                case when x.g >= {rule.least} then concat(acc.out, array(named_struct('s', acc.at + x.p, 'k', {number}, 'e', acc.at + x.p + x.m))) else acc.out end),
              acc -> acc.out) else cast(array() as array<struct<s: int, k: int, e: int>>) end"""
        )
    return f"sort_array(concat({', '.join(parts)}))"


def _verified(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """(row, text, spans): whole rows of ``docs`` as a struct with fields c0, c1, ..."""
    names = docs.columns
    index = stage(postings(docs, rules, id_col, text_col), "postings")
    found = stage(candidates(index, rules), "candidates")
    row = F.struct(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    whole = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("own"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    joined = whole.join(found, F.col("own").eqNullSafe(F.col("id")), "left").selectExpr("row", "text", "coalesce(rules, 0L) as fits")
    return joined.selectExpr("row", "text", f"{_spans(rules, 'text', 'fits')} as spans")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every secret of every whole text, by the base rules and ``rules``.

    Each pattern gives a Boolean query of trigrams. The index of these trigrams over all documents is written, its postings are
    intersected, and only documents that satisfy a query are matched with its pattern. A pattern without a mandatory trigram is
    matched with every text.

    Returns (id, n_assign, n_access, n_hex, base_sha256, spans). Spans are kind:start:end in code points, end exclusive, by start and
    then in the order of the rules; the hash is that of the base kinds' spans alone. A null text counts as empty and has no spans. Rows
    that share an id, or have none, share candidates and are still matched one by one. An empty table gives no rows.
    """
    every = BASE + tuple(rules)
    kinds = f"array({', '.join(_literal(r.kind) for r in every)})"
    name = f"x -> concat_ws(':', element_at({kinds}, x.k + 1), x.s, x.e)"
    found = _verified(columns(docs, id_col, text_col), every, id_col, text_col)
    counts = [f"cast(size(filter(spans, x -> x.k = {i})) as bigint) as n_{r.kind}" for i, r in enumerate(BASE)]
    return found.selectExpr(
        f"row.c0 as `{id_col}`",
        *counts,
        f"sha2(concat_ws(',', transform(filter(spans, x -> x.k < {len(BASE)}), {name})), 256) as base_sha256",
        f"concat_ws(',', transform(spans, {name})) as spans",
    )


def redact(
    docs: DataFrame, rules: tuple[Rule, ...] = MORE, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[secret]"
) -> DataFrame:
    """``docs`` with every secret's span, overlapping ones joined, replaced by ``mark``; ``length_col`` follows where it exists.

    All rows stay, and so do all columns and the texts without a secret, nulls included.
    """
    names, every = docs.columns, BASE + tuple(rules)
    cut = f"""aggregate(spans, named_struct('at', 0, 'out', ''), (acc, x) -> case when x.s >= acc.at
        then named_struct('at', x.e, 'out', concat(acc.out, substring(text, acc.at + 1, x.s - acc.at), {_literal(mark)}))
        else named_struct('at', greatest(acc.at, x.e), 'out', acc.out) end,
        acc -> concat(acc.out, substring(text, acc.at + 1)))"""
    found = _verified(docs, every, id_col, text_col).selectExpr("row", "size(spans) > 0 as hit", f"case when size(spans) > 0 then {cut} end as clean")
    out = []
    for i, n in enumerate(names):
        old, kind = F.col(f"row.c{i}"), docs.schema[n].dataType
        if n == text_col:
            old = F.when(F.col("hit"), F.col("clean")).otherwise(old)
        elif n == length_col:
            old = F.when(F.col("hit"), F.length("clean").cast(kind)).otherwise(old)
        out.append(old.alias(n))
    return found.select(*out)
