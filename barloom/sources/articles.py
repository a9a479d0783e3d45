"""Articles as JSON lines, one folder per day, and feed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import dates, text
from barloom.operators.dedupe import first_per_key, top_per_key
from barloom.sources.tables import write_table

# One line of a raw article file.
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("article_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("canonical_url", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("snippet", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("raw", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("dt", T.DateType()),
    ]
)
# An item of a feed, and the defaults of an article made from it.
ITEM_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("title", "link", "pubDate", "description", "source", "query", "icon")]
    + [T.StructField(c, T.ArrayType(T.StructType([T.StructField("_url", T.StringType())]))) for c in ("media:thumbnail", "media:content", "enclosure")]
)
FEED_SOURCE = "Google News"


def read_articles(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """Article lines, of one day's folder or of all."""
    out = spark.read.schema(ARTICLE_SCHEMA).json(path)
    return out if dt is None else out.filter(F.col("dt") == F.lit(dt).cast("date"))


def write_articles(df: DataFrame, path: str) -> None:
    """Article lines under ``dt=YYYY-MM-DD``; only the days present are replaced."""
    known = [f.name for f in ARTICLE_SCHEMA.fields if f.name in df.columns]
    write_table(df.select(*known), path, by=["dt"], fmt="json")


def item_picture() -> Column:
    """The picture of a feed item: its thumbnail, else media content, else enclosure, and the icon last."""

    def first(name: str) -> Column:
        return F.get(F.filter(F.col(f"`{name}`._url"), lambda u: F.trim(u) != ""), 0)

    return F.trim(F.coalesce(first("media:thumbnail"), first("media:content"), first("enclosure"), text.blank_to_null(F.col("icon"))))


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Items of feed files (XML): trimmed, with a UTC time. Items without title or link are skipped."""
    raw = spark.read.format("xml").option("rowTag", "item").schema(ITEM_SCHEMA).load(path)
    items = raw.select(
        F.trim("title").alias("title"),
        text.unwrap_url(F.trim("link")).alias("link"),
        text.strip_markup(F.coalesce("description", F.lit(""))).alias("snippet"),
        dates.feed_time(F.col("pubDate")).alias("published_at"),
        text.normal_source(F.col("source")).alias("source"),
        "query",
        item_picture().alias("image"),
    )
    return items.filter("title <> '' and link <> ''")


def articles_from_items(
    items: DataFrame, per_query: int | None = None, order: Sequence[str] = ("query", "seq")
) -> DataFrame:
    """Article rows: all items or the first ``per_query`` of each query, each link once (by first appearance in ``order``)."""
    capped = items if per_query is None else top_per_key(items, ["query"], per_query, F.col("seq").asc())
    once = first_per_key(capped.withColumn("_order", F.struct(*order)), ["link"], "_order")
    return once.select(
        text.link_id(F.col("link")).alias("article_id"),
        "title",
        F.col("link").alias("canonical_url"),
        F.coalesce("source", F.lit(FEED_SOURCE)).alias("source"),
        F.lit(None).cast("string").alias("author"),
        "snippet",
        F.lit(None).cast("string").alias("content"),
        (F.col("image") if "image" in once.columns else F.lit(None).cast("string")).alias("image_url"),
        "published_at",
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("string").alias("raw"),
        "seq",
        F.to_date("published_at").alias("dt"),
    )
