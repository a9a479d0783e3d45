"""Editorial content: filters, pages, counts, new rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import text
from barloom.functions.numbers import pages

DEFAULT_TYPE = "analysis"


def search(columns: Sequence[str], term: str) -> Column:
    return text.like_any([F.col(c) for c in columns], term)


def status(mode: str, as_of: datetime | None = None) -> Column:
    """``live``: published by ``as_of``; ``published``: has a date; ``drafts``: has none; ``all``."""
    published = F.col("published_at")
    if mode == "live":
        if as_of is None:
            raise ValueError("live rows need as_of")
        return published.isNotNull() & (published <= F.lit(as_of))
    return {"published": published.isNotNull(), "drafts": published.isNull(), "all": F.lit(True)}[mode]


def where(
    df: DataFrame,
    mode: str = "all",
    as_of: datetime | None = None,
    ticker: str | None = None,
    tags_any: Sequence[str] | None = None,
    term: str | None = None,
    search_in: Sequence[str] = ("title", "excerpt"),
    content_type: str | None = None,
) -> DataFrame:
    """All given conditions together."""
    out = df.filter(status(mode, as_of))
    if ticker:
        out = out.filter(F.col("ticker") == ticker.upper().strip())
    if tags_any:
        out = out.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags_any])))
    if term:
        out = out.filter(search(search_in, term))
    if content_type:
        out = out.filter(F.col("content_type") == content_type)
    return out


def page(df: DataFrame, number: int = 1, size: int = 12, newest: str = "published") -> DataFrame:
    """One page, newest first. ``published`` puts drafts last, ``created`` orders by creation; the id breaks ties."""
    number, size = max(1, int(number)), max(1, int(size))
    created = F.col("created_at").desc()
    order = [F.col("published_at").desc_nulls_last(), created] if newest == "published" else [created]
    return df.orderBy(*order, F.col("id")).offset((number - 1) * size).limit(size)


def count_pages(df: DataFrame, size: int) -> DataFrame:
    """Number of rows and of pages."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("pages", pages(F.col("rows"), size))


def create(df: DataFrame, as_of: datetime, publish: str | None = None) -> DataFrame:
    """New content rows from raw input: texts trimmed, blanks null, slug and tags built, defaults filled.

    ``publish`` names a boolean column; rows where it is true are published at ``as_of``.
    """
    now = F.lit(as_of).cast("timestamp")
    published = F.when(F.col(publish), now) if publish else F.lit(None).cast("timestamp")
    return df.select(
        "id",
        F.trim("title").alias("title"),
        text.slug(F.col("slug"), F.col("title")).alias("slug"),
        F.coalesce("body", F.lit("")).alias("body"),
        text.blank_to_null(F.col("excerpt")).alias("excerpt"),
        text.blank_to_null(F.col("image_url")).alias("image_url"),
        text.blank_to_null(F.upper("ticker")).alias("ticker"),
        text.tags(F.col("tags_csv")).alias("tags"),
        F.coalesce(F.nullif("content_type", F.lit("")), F.lit(DEFAULT_TYPE)).alias("content_type"),
        published.alias("published_at"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
