"""The digest job: article lines of each day to one summary document per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import text
from barloom.operators import news
from barloom.sources.articles import read_articles
from barloom.sources.tables import write_table


def as_lines(articles: DataFrame) -> DataFrame:
    """Dated in-memory articles in the layout of the article files."""
    dated = articles.filter("published_ts is not null")
    return dated.select(
        text.article_id(F.col("url"), F.col("title")).alias("article_id"),
        "title",
        F.col("url").alias("canonical_url"),
        "source",
        "snippet",
        F.lit(None).cast("string").alias("content"),
        F.date_format(F.timestamp_seconds("published_ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        "seq",
        F.to_date(F.timestamp_seconds("published_ts")).alias("dt"),
    )


def write_digest(digests: DataFrame, path: str, summaries: DataFrame | None = None, generated_at: str | None = None) -> None:
    """One document per day: date, article_count, summary, articles and generated_at.

    ``summaries`` (dt, summary) comes from the language service; without it the digest text stands in.
    """
    out = digests
    if summaries is not None:
        out = out.join(summaries, "dt", "left")
    else:
        out = out.withColumn("summary", F.col("text"))
    documents = out.select(
        "dt",
        F.col("dt").cast("string").alias("date"),
        "article_count",
        "summary",
        "articles",
        F.lit(generated_at).cast("string").alias("generated_at"),
    )
    write_table(documents, path, by=["dt"], fmt="json")


def run(
    spark: SparkSession,
    source: str,
    target: str,
    dt: str | None = None,
    n: int = news.DIGEST_ARTICLES,
    hours: int = news.RECENT_HOURS,
    generated_at: str | None = None,
) -> None:
    write_digest(news.digest(read_articles(spark, source, dt), n, hours), target, generated_at=generated_at)
