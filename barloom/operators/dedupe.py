"""One row per key.

All of these filter a row number, for which Spark keeps only the leading rows of each key before the shuffle, so a key with very
many copies does not gather in one task. Spark does so up to a number of rows that a setting names; it is raised where more are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.text import has_real_image, norm_url, title_key


GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _first(df: DataFrame, keys: Sequence[str | Column], *order: Column, n: int = 1) -> DataFrame:
    conf = df.sparkSession.conf
    if n > int(conf.get(GROUP_LIMIT)):
        conf.set(GROUP_LIMIT, str(n))
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= n).drop("_rank")


def latest_snapshot(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of the newest version of each key."""
    return _first(df, keys, F.col(version).desc())


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The newest row of each key, by the order columns descending."""
    return _first(df, keys, *[F.col(c).desc() for c in order])


def first_per_key(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The first row of each key in input order."""
    return _first(df, keys, F.col(order).asc())


def best_per_key(df: DataFrame, keys: Sequence[str | Column], score: str = "score", order: str = "seq") -> DataFrame:
    """The row with the highest score; among equals the first."""
    return _first(df, keys, F.col(score).desc(), F.col(order).asc())


def top_per_key(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    return _first(df, keys, *order, n=n)


def articles(df: DataFrame, url: str = "url", by: Sequence[str] = (), by_title: bool = False) -> DataFrame:
    """One article per address without query and fragment: real image first, then score, then newest, then input order.

    Articles without an address are dropped. ``by_title`` adds a second pass on (source, title key).
    """
    rank = (
        has_real_image(F.col("image")).desc(),
        F.coalesce("score", F.lit(0.0)).desc(),
        F.coalesce("published_ts", F.lit(0)).desc(),
        F.col("seq").asc(),
    )
    out = df.withColumn("_url", norm_url(F.col(url))).filter("_url <> ''")
    out = _first(out, [*by, "_url"], *rank).drop("_url")
    if by_title:
        out = _first(out, [*by, F.coalesce("source", F.lit("")), title_key(F.col("title"))], *rank)
    return out
