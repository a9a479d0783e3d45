"""The daily news job and its back-fill: raw articles to rows of the article table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import text
from barloom.operators import dedupe, merge, news, pages
from barloom.sources.tables import replace, stage


def article_rows(picked: DataFrame) -> DataFrame:
    """Rows of the article table. The address without query and fragment is the key, so one address is one article."""
    url = text.norm_url(F.col("url"))
    content = F.col("content") if "content" in picked.columns else F.lit(None).cast("string")
    author = F.col("author") if "author" in picked.columns else F.lit(None).cast("string")
    return picked.select(
        text.article_id(url, F.col("title")).alias("article_id"),
        "title",
        url.alias("canonical_url"),
        "source",
        F.coalesce(F.nullif(author, F.lit("")), F.nullif("source", F.lit(""))).alias("author"),
        "snippet",
        text.content_or_snippet(content, F.col("snippet")).alias("content"),
        F.when(text.has_real_image(F.col("image")), F.col("image")).alias("image_url"),
        F.timestamp_seconds("published_ts").alias("published_at"),
        "score",
        F.lit(None).cast("string").alias("raw"),
    )


def enrich(picked: DataFrame, page_table: DataFrame) -> DataFrame:
    """Fill missing content and pictures from fetched pages (``url``, ``html``)."""
    wanted = page_table.join(picked.select("url").distinct(), "url", "left_semi")  # parse only pages that were picked
    found = pages.extract(wanted).select("url", F.col("text").alias("_text"), F.col("image").alias("_image"))
    joined = picked.join(found, "url", "left")
    content = F.col("content") if "content" in picked.columns else F.lit(None).cast("string")
    return (
        joined.withColumn("content", F.coalesce(F.nullif(content, F.lit("")), F.nullif("_text", F.lit(""))))
        .withColumn("image", F.when(text.has_real_image(F.col("image")), F.col("image")).otherwise(F.coalesce("_image", "image")))
        .drop("_text", "_image")
    )


def select_articles(
    raw: DataFrame,
    as_of: int,
    n_general: int,
    n_specific: int,
    by: Sequence[str] = (),
    page_table: DataFrame | None = None,
    top_k: int | None = None,
) -> DataFrame:
    """Score, pick per bucket, collapse by address, enrich, collapse again, keep all or the first ``top_k`` in order."""
    picked = news.pick_buckets(news.scored(raw, as_of), n_general, n_specific, by)
    flat = dedupe.articles(picked, by=by)
    if page_table is not None:
        flat = stage(flat, "picked")  # few rows, read by both sides of the page lookup
        flat = dedupe.articles(enrich(flat, page_table), by=by)
    if top_k is not None:
        flat = dedupe.top_per_key(flat, list(by), top_k, F.col("position").asc()) if by else flat.orderBy("position").limit(top_k)
    return article_rows(flat)


def update(articles: DataFrame, picked: DataFrame, order: str | None = None) -> DataFrame:
    """The article table with the picked rows written over rows of the same address; picks that repeat an address need an ``order``."""
    return merge.upsert(articles, picked, ["canonical_url"], order=order)


def run(spark: SparkSession, path: str, picked: DataFrame, order: str | None = None) -> None:
    """Write the picks into the article table at ``path``."""
    replace(update(spark.read.parquet(path), picked, order), path)


def daily_summary(
    summaries: DataFrame, articles: DataFrame, as_of: int, n: int = news.DIGEST_ARTICLES, hours: int = news.RECENT_HOURS
) -> DataFrame:
    """The table of daily summaries (``day``, ``summary``, ...) with the day of ``as_of`` (epoch seconds) written.

    The day's summary is the brief of its candidate articles, up to where a language service would take over; ``article_ids`` is filled
    where the table has that column. A day without candidates carries the last earlier summary forward; without one it gets no row.
    """
    day = F.timestamp_seconds(F.lit(as_of)).cast("date")
    lines = news.brief(news.summary_candidates(articles, as_of, hours), n)
    fields = {"day": day, "summary": F.col("text"), "article_ids": F.col("article_ids")}
    own = lines.select(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in summaries.schema.fields])
    # one row: the newest of the days before
    last = summaries.filter(F.col("day") < day).orderBy(F.col("day").desc()).limit(1)
    carried = last.withColumn("day", day).select(*summaries.columns, F.lit(1).alias("_turn"))
    # the day's own row, else the carried one
    written = own.withColumn("_turn", F.lit(0)).unionByName(carried).orderBy("_turn").limit(1).drop("_turn")
    return merge.upsert(summaries, written, ["day"])


def backfill(scored: DataFrame, start: date, end: date, window_days: int = 10, overlap_days: int = 2, n_general: int = 5, n_specific: int = 5) -> DataFrame:
    """Article rows of every overlapping window; an address picked in several windows keeps the row of the last."""
    spread = news.backfill_windows(scored, start, end, window_days, overlap_days)
    picked = news.pick_buckets(spread, n_general, n_specific, by=["window_start"])
    flat = dedupe.articles(picked, by=["window_start"]).withColumn("_key", text.norm_url(F.col("url")))
    return article_rows(dedupe.latest_per_key(flat, ["_key"], "window_start"))
