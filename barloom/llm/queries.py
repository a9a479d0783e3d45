"""The registered queries of the subpackage, each a thin call of its operator over whole tables, with SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, exact_dedup, hard_negatives, html_text, langid, licenses, nearest, packing, pii, quality, runs, secrets, simhash
from barloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe_codec(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _quality_sql() -> str:
    """The same sketches, merged and read by window functions."""

    def bucket(v: str) -> str:
        shift = f"cast(greatest(length(bin({v})) - {quality.KEPT_BITS}, 0) as bigint)"
        return f"(({v} >> {shift}) << {shift})"

    def limits(name: str, by: str) -> str:
        by = f"{by}, " if by else ""
        return f"""{name}_runs as (select *, sum(n) over (partition by {by}measure order by bucket) as seen, sum(n) over (partition by {by}measure) as total
            from (select {by}measure, bucket, sum(n) as n from sketch group by {by}measure, bucket)),
        {name} as (select {by}measure, cast(max(total) as bigint) as total, min(bucket) filter (100 * seen >= 50 * total) as middle,
            min(bucket) filter (100 * seen >= reach * total) as reach from {name}_runs join params using (measure) group by {by}measure)"""

    params = ", ".join(f"({i}, {m.side}, {m.reach}, {m.times}, {m.slack})" for i, m in enumerate(quality.MEASURES))
    values = " union all ".join(f"select rid, lang, source, {i} as measure, {m.sql.replace(' div ', ' // ')} as v from passed" for i, m in enumerate(quality.MEASURES))
    failed = quality.base_failed()
    least = quality.LEAST_ROWS
    return rf"""with d as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text from documents),
        s as (select *, regexp_extract_all(text, '[^ 	-
]+') as w, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^ 	-
]')] as lines from d),
        windows as (select rid, i, [w[i], w[i + 1], w[i + 2]] as key from (select rid, w, unnest(range(1, len(w) - 1)) as i from s)),
        twice as (select rid, key from windows group by rid, key having count(*) > 1),
        repeats as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from windows join twice using (rid, key)) group by rid),
        counts as (select rid, doc_id, lang, source, cast(len(w) as bigint) as n_words, coalesce(length(array_to_string(w, '')), 0) as word_chars,
            cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
            coalesce(n, 0) as n_repeat_words from s left join repeats using (rid)),
        judged as (select *, {failed} as base_failed from counts),
        passed as (select * from judged where not base_failed),
        vals as ({values}),
        sketch as (select lang, source, measure, {bucket("v")} as bucket, count(*) as n from vals group by lang, source, measure, {bucket("v")}),
        params (measure, side, reach, times, slack) as (values {params}),
        {limits("own", "lang, source")}, {limits("tongue", "lang")}, {limits("every", "")},
        bound as (select o.lang, o.source, o.measure, case when o.total >= {least} then o.middle when t.total >= {least} then t.middle else e.middle end as middle,
            case when o.total >= {least} then o.reach when t.total >= {least} then t.reach else e.reach end as reach
            from own o join tongue t on o.lang is not distinct from t.lang and o.measure = t.measure join every e on e.measure = o.measure),
        beyond as (select distinct rid from vals v join bound b on v.lang is not distinct from b.lang and v.source is not distinct from b.source and v.measure = b.measure
            join params p on p.measure = v.measure where side * (v - (middle + side * (times * abs(middle - b.reach) + slack))) > 0)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and beyond.rid is null as kept
        from judged left join beyond using (rid)"""


@query
def op2_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


ORACLE["op2_quality_rules"] = _quality_sql()


@query
def op3_personal_data(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op4_main_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op5_nearest_blocks(spark, sf_dir):
    return nearest.search(table(spark, sf_dir, "embeddings"))


ORACLE["op5_nearest_blocks"] = """with v as (select distinct vec_id, [cast(x as double) for x in embedding] as e from embeddings
        where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x != 0]) > 0),
    pairs as (select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda x, y: x + y)) as score from v q join v c on q.vec_id != c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0)
    select query_id, cast(rank as int) as rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score, vec_id) as rank from pairs) where rank <= 10"""


@query
def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_language_ppm(spark, sf_dir):
    return langid.predict(table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark, sf_dir):
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    """Every rule matched with every text; a match starts after all pieces and matches before it."""

    def matches(number: int, rule: secrets.Rule) -> str:
        p = rule.pattern.replace("'", "''")
        return f"""select rid, {number} as k, '{rule.kind}' as kind, s, s + length(m[i]) as e from (
            select *, cast(list_sum([length(x) for x in pieces[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0) as bigint) as s from (
              select *, unnest(range(1, len(m) + 1)) as i from (
                select rid, string_split_regex(text, '{p}') as pieces, regexp_extract_all(text, '{p}', 0) as m, regexp_extract_all(text, '{p}', {rule.group}) as g
                from d where regexp_matches(text, '{p}')))) where length(g[i]) >= {rule.least}"""

    found = " union all ".join(matches(i, r) for i, r in enumerate(secrets.RULES))
    base = len(secrets.BASE)
    counts = ", ".join(f"count(*) filter (k = {i}) as n_{r.kind}" for i, r in enumerate(secrets.BASE))
    names = ", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secrets.BASE)
    return f"""with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
        found as ({found}),
        spans as (select rid, {counts}, string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans,
            string_agg(kind || ':' || s || ':' || e, ',' order by s, k) filter (k < {base}) as base from found group by rid)
        select doc_id, {names}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join spans using (rid)"""


@query
def op10_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


ORACLE["op10_secret_scan"] = _secrets_sql()


@query
def op13_exact_dedup(spark, sf_dir):
    return exact_dedup.dedupe(table(spark, sf_dir, "documents"))


ORACLE["op13_exact_dedup"] = """with d as (select doc_id, coalesce(text, '') as text from documents),
    g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256 from d join g using (text)"""


@query
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


ORACLE["op12_hard_negatives"] = """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
        where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    s as (select a.vec_id as a, a.label = c.label as same, c.vec_id as c, cast(list_sum([x[1] * x[2] for x in list_zip(a.e, c.e)]) as bigint) as score
        from v a join v c on a.vec_id % 100 = 0 and a.vec_id != c.vec_id),
    p as (select * from (select a, c, score, row_number() over (partition by a order by score desc, c) as n from s where same) where n <= 5)
    select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from (
        select p.a as anchor_id, p.c as positive_id, s.c as negative_id, p.score as positive_score, s.score as negative_score,
            row_number() over (partition by p.a, p.c order by s.score desc, s.c) as rank
        from p join s on s.a = p.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score) where rank <= 10"""


def _with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's made repetition: from some word on, the texts of a tenth of the ids repeat."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query
def op11_periodic_runs(spark, sf_dir):
    found = runs.detect(table(spark, sf_dir, "documents"), reshape=_with_planted_period)
    best = F.expr("array_sort(runs, (x, y) -> case when x.length != y.length then int(signum(y.length - x.length)) when x.start != y.start then int(signum(x.start - y.start)) else int(signum(x.period - y.period)) end)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    longest = found.withColumn("best", F.get(best, F.lit(0)))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
