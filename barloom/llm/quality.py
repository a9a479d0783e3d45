"""Quality rules with thresholds from mergeable quantile sketches; DataFrame and SQL functions only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stage


class Measure(NamedTuple):
    """A measure in thousandths. Texts are rejected beyond the median plus ``times`` the distance from there to the quantile at ``reach``
    percent, and ``slack``; that quantile lies on the side where texts are rejected. ``side`` 1 rejects above, -1 below."""

    name: str
    sql: str
    side: int
    reach: int
    times: int
    slack: int


#: The words of a text are compared as they stand; measures are whole thousandths, so that every engine gives the same numbers. The quartile
#: on the rejecting side moves with a group's own texts and not with junk that is under a quarter of them. Lines count four more than
#: there are, so that one repeated line in a very short text is no large share.
MEASURES = (
    Measure("word_length", "1000 * word_chars div n_words", 1, 75, 6, 1000),
    Measure("word_length_low", "1000 * word_chars div n_words", -1, 25, 6, 1000),
    Measure("symbols", "1000 * n_symbols div n_words", 1, 75, 6, 50),
    Measure("dup_lines", "1000 * n_dup_lines div (n_lines + 4)", 1, 75, 6, 250),
    Measure("repeats", "1000 * n_repeat_words div n_words", 1, 75, 6, 350),
)
#: Values below 2**KEPT_BITS are their own bucket of a sketch; larger ones keep that many leading bits, an error under 1 part in 64.
KEPT_BITS = 7
#: A group with fewer rows takes the sketch of its language, and a language with fewer that of all rows.
LEAST_ROWS = 200
MIN_WORDS, MAX_REPEATS = 50, 50

#: fixed values: what separates words, and what counts as a symbol
BLANKS, SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and n_repeat_words of the text."""
    text = f"coalesce(`{text_col}`, '')"
    lines = rf"filter(split({text}, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"
    words = docs.withColumn("words", F.expr(rf"filter(split({text}, '[\\x20\\x09-\\x0D]+', -1), x -> x != '')")).withColumn("lines", F.expr(lines))
    # windows as hashes, 64 bits each; only texts in which one occurs twice are looked at further
    windows = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
    hashed = words.withColumn("windows", F.expr(f"case when size(words) > 2 then {windows} else cast(array() as array<bigint>) end"))
    ordered = "array_sort(transform(windows, (x, i) -> named_struct('x', x, 'i', i)))"
    known = hashed.withColumn("ordered", F.expr(f"case when size(array_distinct(windows)) < size(windows) then {ordered} end"))
    twice = """filter(transform(ordered, (o, j) ->
        case when (j > 0 and ordered[j - 1].x = o.x) or (j + 1 < size(ordered) and ordered[j + 1].x = o.x) then o.i end), i -> i is not null)"""
    return known.selectExpr(
        *[f"`{c}`" for c in docs.columns],
        "cast(size(words) as bigint) as n_words",
        "cast(length(array_join(words, '')) as bigint) as word_chars",
        rf"cast(regexp_count({text}, '[#*$%&|<>]') as bigint) as n_symbols",
        "cast(size(lines) as bigint) as n_lines",
        "cast(size(lines) - size(array_distinct(lines)) as bigint) as n_dup_lines",
        f"cast(case when ordered is null then 0 else size(array_distinct(flatten(transform({twice}, i -> array(i, i + 1, i + 2))))) end as bigint) as n_repeat_words",
    )


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> str:
    return f"({n_words} < {MIN_WORDS} or 100 * {n_repeat_words} > {MAX_REPEATS} * {n_words})"


def bucket(value: str) -> str:
    """SQL for the bucket of a sketch, its least value: the leading bits of a whole number."""
    shift = f"greatest(length(bin({value})) - {KEPT_BITS}, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): a quantile sketch of each measure for every group, from rows that pass the base rules.

    A sketch is the count of values per bucket, so sketches merge by adding counts, in any order, with the same result.
    """
    values = ", ".join(f"named_struct('measure', {i}, 'value', {m.sql})" for i, m in enumerate(MEASURES))
    spread = measured.where(f"not {base_failed()}").selectExpr("lang", "source", f"explode(array({values})) as v")
    return spread.selectExpr("lang", "source", "v.measure as measure", f"{bucket('v.value')} as bucket").groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def _limits(sketch: DataFrame, by: list[str]) -> DataFrame:
    """One row for each group of ``by``: the rows it counts, and an array of limits by measure."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    # a sketch has few buckets: at most 2**(KEPT_BITS - 1) for each doubling of the values
    listed = merged.groupBy(*by, "measure").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("parts"))

    def quantile(percent: str) -> str:
        return f"""aggregate(parts, named_struct('seen', 0L, 'at', cast(null as bigint)), (acc, p) -> named_struct('seen', acc.seen + p.n,
            'at', case when acc.at is null and 100 * (acc.seen + p.n) >= {percent} * total then p.bucket else acc.at end), acc -> acc.at)"""

    def of(column: str) -> str:
        return f"element_at(array({', '.join(str(getattr(m, column)) for m in MEASURES)}), measure + 1)"

    middle = listed.selectExpr(*by, "measure", "total", f"{quantile('50')} as middle", f"{quantile(of('reach'))} as reach")
    limit = f"middle + {of('side')} * ({of('times')} * abs(middle - reach) + {of('slack')})"
    found = middle.selectExpr(*by, "total", f"named_struct('measure', measure, 'limit', {limit}) as l")
    return found.groupBy(*by).agg(F.max("total").alias("total"), F.expr("transform(sort_array(collect_list(l)), x -> x.limit)").alias("limits"))


def thresholds(sketch: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, limits) for every group: of its own sketch, or where rows are few of its language's or of all."""
    groups = _limits(sketch, ["lang", "source"])
    langs = _limits(sketch, ["lang"]).select(F.col("lang").alias("l"), F.col("total").alias("lang_total"), F.col("limits").alias("lang_limits"))
    every = _limits(sketch.withColumn("every", F.lit(0)), ["every"]).select("every", F.col("limits").alias("all_limits"))
    joined = groups.withColumn("every", F.lit(0)).join(langs, F.col("lang").eqNullSafe(F.col("l"))).join(F.broadcast(every), "every")  # one row
    chosen = F.when(F.col("total") >= least_rows, F.col("limits")).when(F.col("lang_total") >= least_rows, F.col("lang_limits")).otherwise(F.col("all_limits"))
    return joined.select("lang", "source", chosen.alias("limits"))


def _judged(measured: DataFrame, least_rows: int) -> DataFrame:
    """Staged counts plus base_failed and kept."""
    limits = stage(thresholds(stage(sketches(measured), "sketches"), least_rows), "thresholds").toDF("l", "s", "limits")
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    within = " and ".join(f"{m.sql} {'<=' if m.side > 0 else '>='} limits[{i}]" for i, m in enumerate(MEASURES))
    return joined.withColumn("base_failed", F.expr(base_failed())).withColumn("kept", F.expr(f"case when {base_failed()} then false else coalesce({within}, true) end"))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_rows: int = LEAST_ROWS
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) per row.

    Rows that pass the base rules are kept unless a measure lies beyond the threshold of their language and source. Thresholds are
    the median plus multiples of the distance to the quartile on the side of junk, which junk does not move while it is less than a quarter
    of a group, and a small floor, which decides where three quarters of a group have none of a measure.

    A null text has no words and fails. Null languages and sources are groups of their own. Repeated rows and null ids each return
    their row. An empty table gives no rows. Whole texts are counted; other columns are not read.
    """
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id_col, "id"), (text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    measured = stage(counted(rows).drop("text"), "counts")
    return _judged(measured, least_rows).select(F.col("id").alias(id_col), *COUNTS, "base_failed", "kept")


def keep_good(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_rows: int = LEAST_ROWS
) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps; columns stay as they are.

    Rows travel with their counts, so that repeated and null ids need no key.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).alias("row"),
        *[F.col(f"`{c}`").alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))],
    )
    # no filter before the write: it would be pushed below the counts and evaluate them inside their own loops
    measured = stage(counted(rows).drop("text"), "counts").where(f"not {base_failed()}")
    kept = _judged(measured, least_rows).where("kept")
    return kept.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)])
