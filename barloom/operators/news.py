"""News: scoring, ranking, buckets, windows, digests and daily summaries.

Articles carry ``seq`` (input order, unique), ``title``, ``url``, ``source``, ``snippet``, ``image`` and ``published_ts`` (epoch
seconds). ``by`` names the columns that separate independent batches, so one job ranks every day or window at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import text
from barloom.functions.dates import epoch_day
from barloom.operators import dedupe
from barloom.operators.blocks import latest, running

RECENT_HOURS = 36
DIGEST_ARTICLES = 10
GENERAL, SPECIFIC = "general", "specific"


def recent(df: DataFrame, as_of: int | Column, hours: int = RECENT_HOURS, column: str = "published_ts") -> DataFrame:
    """Articles of the last ``hours``; undated ones are out."""
    as_of = F.lit(as_of) if isinstance(as_of, int) else as_of
    return df.filter(F.col(column) >= as_of - hours * 3600)


def list_news(
    df: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    source: str | None = None,
    q: str | None = None,
    limit: int = 20,
    page: int = 1,
) -> DataFrame:
    """One page, newest first with undated articles leading; inclusive range, exact source, search in title and snippet."""
    if page < 1:
        raise ValueError("page counts from 1")
    out = df
    if start is not None:
        out = out.filter(F.col("published_at") >= F.lit(start))
    if end is not None:
        out = out.filter(F.col("published_at") <= F.lit(end))
    if source:
        out = out.filter(F.col("source") == source)
    if q:
        out = out.filter(text.like_any([F.col("title"), F.col("snippet")], q))
    return out.orderBy(F.col("published_at").desc_nulls_first(), F.col("seq")).offset((page - 1) * limit).limit(limit)


def scored(df: DataFrame, as_of: int | Column) -> DataFrame:
    return df.withColumn("score", text.score(F.col("published_ts"), F.col("source"), F.col("title"), as_of))


def _recency() -> Column:
    return F.coalesce("published_ts", F.lit(0))


def best_titles(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One scored article per title key: the best score, among equals the first. ``first_seq`` is where the title first appeared.

    An aggregate rather than a window, so copies of one title combine before the shuffle.
    """
    keyed = df.withColumn("_title", text.title_key(F.col("title")))
    best = keyed.groupBy(*by, "_title").agg(
        F.max_by(F.struct(*df.columns), F.struct("score", -F.col("seq"))).alias("_best"), F.min("seq").alias("first_seq")
    )
    return best.select("_best.*", "first_seq")


def rank(df: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` best titles of each batch by score, then recency, then first appearance, with ``rank`` from 1."""
    best = best_titles(df, by)
    order = (F.col("score").desc(), _recency().desc(), F.col("first_seq").asc())
    if not by:
        best = best.orderBy(*order).limit(k)  # sorted top rows per task, then merged
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def top_k(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` best articles as they are, by score, then recency, then input order."""
    return df.orderBy(F.col("score").desc(), _recency().desc(), F.col("seq").asc()).limit(k)


def pick_buckets(df: DataFrame, n_general: int, n_specific: int, by: Sequence[str] = ()) -> DataFrame:
    """The best of two buckets per batch, without taking an article twice.

    Each bucket ranks its best titles by score, then recency. General picks come first, specific picks skip what general took, and a thin bucket is topped up
    from what both have left. ``position`` orders the result by score, then recency.

    Exact: of a bucket only the best title of each address can be picked, and the n_general + n_specific best addresses are all that picks and top-up can
    come to, so that many are kept, however many titles share an address.
    """
    wanted = n_general + n_specific
    batch = [*by] or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(0))
    titles = best_titles(source.filter(F.col("bucket").isin(GENERAL, SPECIFIC)), [*batch, "bucket"])
    order = (F.col("score").desc(), _recency().desc(), F.col("first_seq").asc())
    # what an address offers besides its best title combines away before the shuffle
    one = dedupe.top_per_key(titles.withColumn("_id", text.article_id(F.col("url"), F.col("title"))), [*batch, "bucket", "_id"], 1, *order)
    # the other bucket may take as many as it wants of the same addresses
    offered = dedupe.top_per_key(one, [*batch, "bucket"], 2 * wanted, *order)
    ranks = Window.partitionBy(*batch, "bucket").orderBy(*order)
    # from here on a batch has at most the two pools
    w = Window.partitionBy(*batch)
    turn = F.when(F.col("bucket") == GENERAL, 0).otherwise(1)
    pool = offered.withColumn("rank", F.row_number().over(ranks)).repartition(*batch).withColumn("_turn", turn)

    def take(frame: DataFrame, eligible: Column, n: int | Column, name: str) -> DataFrame:
        ordered = Window.partitionBy(*batch, "_may").orderBy("_turn", "rank")
        frame = frame.withColumn("_may", eligible)
        return frame.withColumn(name, F.col("_may") & (F.row_number().over(ordered) <= n)).drop("_may")

    same = Window.partitionBy(*batch, "_id")
    pool = take(pool, F.col("_turn") == 0, n_general, "_g")
    pool = pool.withColumn("_g_has", F.max("_g").over(same))
    pool = take(pool, (F.col("_turn") == 1) & ~F.col("_g_has"), n_specific, "_s")
    pool = pool.withColumn("_taken", F.max(F.col("_g") | F.col("_s")).over(same))
    pool = pool.withColumn("_short", F.lit(wanted) - F.sum((F.col("_g") | F.col("_s")).cast("int")).over(w))
    left = ~F.col("_taken") & (F.row_number().over(Window.partitionBy(*batch, "_id").orderBy("_turn", "rank")) == 1)
    pool = take(pool.withColumn("_left", left), F.col("_left"), F.col("_short"), "_more")
    chosen = pool.filter("_g or _s or _more").withColumn("_stage", F.when(F.col("_g"), 0).when(F.col("_s"), 1).otherwise(2))
    final = Window.partitionBy(*batch).orderBy(F.col("score").desc(), _recency().desc(), "_stage", "_turn", "rank")
    return chosen.withColumn("position", F.row_number().over(final)).select(*df.columns, "rank", "position")


def cap_per_query(df: DataFrame, n: int, key: str = "query") -> DataFrame:
    """The first ``n`` items of each feed query in input order."""
    return dedupe.top_per_key(df, [key], n, F.col("seq").asc())


def tag_tickers(df: DataFrame, tickers: DataFrame, columns: Sequence[str] = ("title", "snippet")) -> DataFrame:
    """(article, ticker) for every ticker an article mentions as a word, in any case. Words may hold single dots and dashes, as tickers
    do; such a word also counts as its parts.

    Texts become distinct words that meet the tickers in an equi join; matching every article with every ticker would be a cross join.
    """
    whole = F.upper(F.concat_ws(" ", *columns))
    parts = F.split(whole, r"[^\p{L}\p{N}]+")
    compound = F.regexp_extract_all(whole, F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)+"), F.lit(0))
    words = F.array_distinct(F.concat(parts, compound))
    mentioned = df.select("seq", F.explode(words).alias("ticker")).filter("ticker <> ''")
    return mentioned.join(tickers.select(F.upper("ticker").alias("ticker")).distinct(), "ticker").select("seq", "ticker")


#: Words that, after a ticker, say that the company is meant.
TRADED = ("STOCK", "SHARES")
_NO_WORD = r"[^\p{L}\p{N}]+"


def mention_forms(tickers: DataFrame) -> DataFrame:
    """(ticker, form, phrase) of the ways in which an article may mention a company: the ticker in quotes, the ticker before a word of :data:`TRADED`, and
    the name, where ``tickers`` (``ticker``) has a column ``name``. Phrases are words in capitals joined by blanks."""
    spelled = lambda c: F.trim(F.regexp_replace(F.upper(c), _NO_WORD, " "))
    word = spelled(F.col("ticker"))
    forms = [F.struct(F.lit("quoted").alias("form"), word.alias("phrase"))]
    forms += [F.struct(F.lit(w.lower()).alias("form"), F.concat(word, F.lit(f" {w}")).alias("phrase")) for w in TRADED]
    if "name" in tickers.columns:
        forms.append(F.struct(F.lit("name").alias("form"), spelled(F.col("name")).alias("phrase")))
    out = tickers.select(F.upper("ticker").alias("ticker"), F.inline(F.array(*forms)))
    return out.filter("phrase is not null and trim(phrase) <> ''").distinct()


def tag_mentions(df: DataFrame, forms: DataFrame, columns: Sequence[str] = ("title", "snippet")) -> DataFrame:
    """(seq, ticker, form) for every form in which an article mentions a ticker, so that a ticker that is a common word does not tag everything.

    Texts become the distinct runs of as many words as some phrase has, and quoted passages as they are, which meet the phrases in an equi join. Only the different
    numbers of words of the phrases come to the driver.
    """
    text_of = F.upper(F.concat_ws(" ", *columns))
    sizes = sorted(r[0] for r in forms.filter("form <> 'quoted'").select(F.size(F.split("phrase", " "))).distinct().collect())
    none = F.array().cast("array<string>")

    def runs_of(words: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(none)

    def runs(words: Column) -> Column:
        return F.array_distinct(F.flatten(F.array(none, *[runs_of(words, n) for n in sizes])))

    # the words are worked out once and named in the lambda
    words = F.filter(F.split(text_of, _NO_WORD), lambda w: w != "")
    quoted = F.transform(F.regexp_extract_all(text_of, F.lit(r'["“]([^"“”]+)["”]'), F.lit(1)), lambda q: F.trim(F.regexp_replace(q, _NO_WORD, " ")))
    said = df.select("seq", F.flatten(F.transform(F.array(words), runs)).alias("plain"), F.array_distinct(quoted).alias("quoted"))
    each = said.select("seq", F.explode("plain").alias("phrase"), F.lit(False).alias("_quoted")).unionAll(
        said.select("seq", F.explode("quoted").alias("phrase"), F.lit(True).alias("_quoted"))
    )
    marked = forms.withColumn("_quoted", F.col("form") == "quoted")
    return each.join(marked, ["phrase", "_quoted"]).select("seq", "ticker", "form").distinct()


def summary_candidates(df: DataFrame, as_of: int, hours: int = RECENT_HOURS, by: Sequence[str] = ()) -> DataFrame:
    """Articles of the day of ``as_of``; a batch that has none gets those of the last ``hours``."""
    today = epoch_day(F.col("published_ts")) == epoch_day(F.lit(as_of))
    dated = df.filter("published_ts is not null and published_ts <> 0").withColumn("_today", today)
    kept = dated.filter(F.col("_today") | (F.col("published_ts") >= as_of - hours * 3600))
    if by:
        kept = kept.join(kept.groupBy(*by).agg(F.max("_today").alias("_any")), [*by])
    else:
        # one value for all, asked for as a scalar: a join without a key would be a cross join
        kept = kept.withColumn("_any", kept.agg(F.max("_today")).scalar())
    out = kept.filter(F.col("_today") | (~F.col("_any") & (F.col("published_ts") >= as_of - hours * 3600)))
    return out.select(*df.columns)


def _block(a: Column, snippet_chars: int | None, content_chars: int | None) -> Column:
    """The lines of one article in a digest, closed by an empty line."""

    def text_of(name: str) -> Column:
        return F.coalesce(a[name], F.lit(""))

    snippet = F.substring(text_of("snippet"), 1, snippet_chars) if snippet_chars else text_of("snippet")
    content = F.substring(text_of("content"), 1, content_chars) if content_chars else text_of("content")
    lines = F.array(
        F.concat(F.lit("["), a["rank"].cast("string"), F.lit("] "), text_of("title")),
        F.when(
            (text_of("source") != "") | (text_of("published_at") != ""),
            F.concat(F.lit("Source: "), text_of("source"), F.lit(" | Time: "), text_of("published_at")),
        ),
        F.when(text_of("canonical_url") != "", F.concat(F.lit("URL: "), text_of("canonical_url"))),
        F.when(content != "", F.concat(F.lit("Content: "), content)).when(
            snippet != "", F.concat(F.lit("Snippet: "), snippet)
        ),
        F.lit(""),
    )
    return F.array_join(F.array_compact(lines), "\n")


def digest(
    df: DataFrame,
    n: int = DIGEST_ARTICLES,
    hours: int = RECENT_HOURS,
    day: str = "dt",
    snippet_chars: int | None = None,
    content_chars: int | None = None,
) -> DataFrame:
    """One row per day: its ``n`` newest articles of the last ``hours`` (to the end of the day) as records and as one text.

    The text has whole snippets and contents unless ``snippet_chars`` and ``content_chars`` say how much of each to show.
    Ranking keeps at most ``n`` articles per day before the shuffle, so collecting them is bounded.
    """
    seconds = F.unix_timestamp(F.col("published_at_ts")).alias("_ts")
    dated = df.withColumn("published_at_ts", F.try_to_timestamp("published_at")).withColumn("_ts", seconds)
    end = F.unix_timestamp(F.date_add(F.col(day), 1).cast("timestamp"))
    fresh = recent(dated, end, hours, "_ts").filter(F.col("_ts") < end)
    order = Window.partitionBy(day).orderBy(F.col("_ts").desc(), F.col("seq").asc())
    fields = ("article_id", "title", "canonical_url", "source", "snippet", "content", "published_at")
    ranked = fresh.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    out = ranked.groupBy(day).agg(
        F.count(F.lit(1)).alias("article_count"), F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("articles")
    )
    return out.select(
        day,
        "article_count",
        F.array_join(F.transform("articles", lambda a: _block(a, snippet_chars, content_chars)), "\n").alias("text"),
        F.transform("articles", lambda a: F.struct(*[a[f].alias(f) for f in fields])).alias("articles"),
    )


WHOLE = 2**31 - 1  # longer than any text


def bullet(published_ts: Column, title: Column, source: Column, title_chars: int | None = None, source_chars: int | None = None) -> Column:
    """One headline line: time, title and source, clipped only where lengths are given."""

    def shown(value: Column, chars: int | None) -> Column:
        return text.clip(value, WHOLE if chars is None else chars)

    when = F.coalesce(F.date_format(F.timestamp_seconds(published_ts), "yyyy-MM-dd HH:mm"), F.lit(""))
    return F.concat(
        F.lit("- ["), when, F.lit("] "), shown(title, title_chars), F.lit(" ("), shown(source, source_chars), F.lit(")")
    )


def brief(
    df: DataFrame, n: int = DIGEST_ARTICLES, by: Sequence[str] = (), title_chars: int | None = None, source_chars: int | None = None
) -> DataFrame:
    """Headline lines and ids of the ``n`` newest candidates of each batch."""
    batch = [*by] or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(0))
    newest = dedupe.top_per_key(source, batch, n, _recency().desc(), F.col("seq").asc())
    item = F.struct(
        (-_recency()).alias("o"),
        F.col("seq"),
        bullet(F.col("published_ts"), F.col("title"), F.col("source"), title_chars, source_chars).alias("line"),
        text.article_id(text.norm_url(F.col("url")), F.col("title")).alias("id"),
    )
    out = newest.groupBy(*batch).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return out.select(
        *by, F.array_join(F.col("_items.line"), "\n").alias("text"), F.col("_items.id").alias("article_ids")
    )


def backfill_windows(
    df: DataFrame, start: date, end: date, window_days: int = 10, overlap_days: int = 2
) -> DataFrame:
    """Each article once per overlapping window it falls into, with ``window_start`` and ``window_end`` (inclusive days, the last one clipped)."""
    step = max(1, window_days - overlap_days)
    day = epoch_day(F.col("published_ts"))
    into = F.datediff(day, F.lit(start))
    last = F.floor(into / step)
    first = F.greatest(F.lit(0), F.ceil((into - window_days + 1) / step))
    inside = df.filter(day.between(F.lit(start), F.lit(end)))
    spread = inside.withColumn("_w", F.explode(F.sequence(first, last)))
    begins = F.date_add(F.lit(start), (F.col("_w") * step).cast("int"))
    return spread.withColumn("window_start", begins).withColumn(
        "window_end", F.least(F.date_add("window_start", window_days - 1), F.lit(end))
    ).drop("_w")


def fill_daily_summary(summaries: DataFrame, days: DataFrame) -> DataFrame:
    """A summary for every day: its own, or the last earlier one, marked ``carried``. Days before the first summary are left out."""
    fields = [c for c in summaries.columns if c != "day"]
    joined = days.select("day").distinct().join(summaries, "day", "left").withColumn("_all", F.lit(0))
    own = F.exists(F.array(*[F.col(c).isNotNull() for c in fields]), lambda x: x)
    joined = joined.withColumn("_row", F.when(own, F.struct("day", *fields)))
    filled = running(joined.select("_all", "day", "_row"), ["_all"], "day", {"_last": latest(F.col("_row"))})
    return filled.filter("_last is not null").select(
        "day", *[F.col(f"_last.{c}").alias(c) for c in fields], (F.col("_last.day") != F.col("day")).alias("carried")
    )
