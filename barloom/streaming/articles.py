"""Article stream without repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import text
from barloom.operators.dedupe import top_per_key
from barloom.sources.tables import stage
from barloom.streaming import partials


def unique_articles(articles: DataFrame, lateness: str = "2 days", time: str = "published_at") -> DataFrame:
    """Each address once within ``lateness``, by its form without query and fragment; a later repeat comes out again, and an article later
    than that is dropped. :func:`store_unique` keeps each address once for good."""
    return (
        articles.withColumn(time, F.col(time).cast("timestamp"))
        .withColumn("canonical_url", text.norm_url(F.col("canonical_url")))
        .withWatermark(time, lateness)
        .dropDuplicatesWithinWatermark(["canonical_url"])
    )


BUCKETS = 64


def _earliest(rows: DataFrame, time: str, order: str | None) -> DataFrame:
    """The first article of each address by time, then ``order``; undated ones come last."""
    turn = [F.col(time).asc_nulls_last(), *([F.col(order).asc_nulls_last()] if order else [])]
    return top_per_key(rows, ["canonical_url"], 1, *turn)


def store_unique(articles: DataFrame, path: str, checkpoint: str, time: str = "published_at", order: str | None = None, buckets: int = BUCKETS) -> None:
    """Keep of the articles of a stream, in the table at ``path``, the earliest of each address, in whatever order they come; :func:`read_unique` reads it.

    A micro-batch stores an article whose address is new, or which is earlier than the stored one by ``time``, then ``order`` (without one, articles
    of the same time count as the same). It reads only the address-hash buckets that it touches, and of them address, time and order. No state is held, no article is too late, a
    repeated batch replaces itself, and the folders of old batches are merged.
    """
    spark = articles.sparkSession
    key = ["canonical_url", time, *([order] if order else [])]

    def fold(batch: DataFrame, batch_id: int) -> DataFrame:
        named = batch.withColumn("canonical_url", text.norm_url(F.col("canonical_url"))).withColumn(time, F.col(time).cast("timestamp"))
        fresh = _earliest(named, time, order).withColumn("bucket", F.pmod(F.xxhash64("canonical_url"), F.lit(buckets)).cast("int"))
        if batch_id == 0:
            return fresh
        fresh = stage(fresh, "fresh-articles")
        return improved(fresh, stored_keys(spark, path, batch_id, [r[0] for r in fresh.select("bucket").distinct().collect()], key), time, order)

    partials.start(articles, path, checkpoint, fold, ["bucket"], lambda rows: _earliest(rows, time, order))


def stored_keys(spark: SparkSession, path: str, batch_id: int, touched: list[int], key: list[str]) -> DataFrame:
    """What earlier batches hold in the touched buckets; at most as many literals as there are buckets, which prune the folders that are read."""
    return partials.read(spark, path).filter((F.col("batch") < batch_id) & F.col("bucket").isin(touched)).select(*key)


def improved(fresh: DataFrame, stored: DataFrame, time: str, order: str | None) -> DataFrame:
    """The fresh articles whose address is not stored, or only later. Several stored rows of an address are reduced to the earliest first."""
    turn = [time, *([order] if order else [])]
    rank = lambda df: F.struct(*[x for c in turn for x in (df[c].isNull().alias(f"{c}_no"), df[c].alias(c))])
    best = stored.groupBy("canonical_url").agg(F.min(rank(stored)).alias("_best"))
    return fresh.join(best, "canonical_url", "left").filter(F.col("_best").isNull() | (rank(fresh) < F.col("_best"))).select(*fresh.columns)


def read_unique(spark: SparkSession, path: str, time: str = "published_at", order: str | None = None) -> DataFrame:
    """The table of :func:`store_unique`: each address once."""
    return _earliest(partials.read(spark, path), time, order).drop("batch", "bucket")
