"""A table of the latest row per key, fed by a stream of changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.dedupe import latest_per_key
from barloom.sources.tables import spread, stage


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def upsert_into(path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64, order: str = "seq") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the last change per key in Parquet, split into key-hash buckets.

    Only buckets a batch touches are rewritten. Deleted keys stay as rows with ``op`` D, so an older change that arrives late cannot bring them
    back, and repeating a batch after a failure gives the same table.
    """
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.createDataFrame([], stored).write.mode("append").partitionBy("bucket").parquet(path)
        changes = stage(latest_per_key(batch, keys, order).withColumn("bucket", _bucket(keys, buckets)), "changes")
        # at most ``buckets`` numbers; as literals they prune the folders that are read
        touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]
        current = spark.read.schema(stored).parquet(path).filter(F.col("bucket").isin(touched))
        merged = stage(latest_per_key(current.unionByName(changes), keys, order), "merged")
        (
            spread(merged, ["bucket"])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(path)
        )

    return write


def start_upsert(changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 64, order: str = "seq") -> None:
    """Apply all changes present in the stream to the table at ``path``."""
    query = (
        changes.writeStream.foreachBatch(upsert_into(path, changes.schema, keys, buckets, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the table, without deleted keys."""
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(stored).parquet(path).filter("op <> 'D'").drop("op", "bucket")
