"""Streams whose results do not depend on how rows are cut into micro-batches.

Every micro-batch writes its partial results to a folder of its own, so a repeated batch replaces itself and late or out-of-order rows
are never dropped. Readers merge the partial results; no state is held between batches. ``compact`` merges old folders into one, so their number stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

Fold = Callable[[DataFrame, int], DataFrame]
Merge = Callable[[DataFrame], DataFrame]
MERGED = "_merged-"  # readers pass over names that start so


def start(
    stream: DataFrame, path: str, checkpoint: str, fold: Fold, by: Sequence[str] = (), merge: Merge | None = None, every: int = 50
) -> None:
    """Fold every micro-batch of the data present into ``path``; ``fold`` also gets the number of the batch.

    ``by`` splits a batch's folder further. With ``merge``, from partial rows to fewer partial rows, every ``every`` batches the older ones are merged.
    """
    if merge is not None:
        _finish(stream.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if merge is not None and batch_id and batch_id % every == 0:
            compact(batch.sparkSession, path, merge, by, batch_id - 1)
        writer = _whole(fold(batch, batch_id))
        (writer.partitionBy(*by) if by else writer).parquet(f"{path}/batch={batch_id}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _whole(rows: DataFrame) -> DataFrameWriter:
    """A writer that replaces the whole folder, not only the parts present in ``rows``, and marks it when it is complete."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "static")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def _folders(spark: SparkSession, path: str):
    """(file system, {batch: folder}, merged folders that were written to the end)"""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = [f.getPath() for f in files.listStatus(at)] if files.exists(at) else []
    batches = {int(p.getName().removeprefix("batch=")): p for p in listed if p.getName().startswith("batch=")}
    merged = [p for p in listed if p.getName().startswith(MERGED) and files.exists(hadoop.Path(p, "_SUCCESS"))]
    return files, batches, merged, hadoop


def _finish(spark: SparkSession, path: str) -> None:
    """Put a merged folder that is complete in the place of the batches it holds, also after a failure half way."""
    files, batches, merged, hadoop = _folders(spark, path)
    for folder in merged:
        last = int(folder.getName().removeprefix(MERGED))
        for number, old in batches.items():
            if number <= last:
                files.delete(old, True)
        if not files.rename(folder, hadoop.Path(path, f"batch={last}")):
            raise OSError(f"cannot move {folder.toString()}")


def compact(spark: SparkSession, path: str, merge: Merge, by: Sequence[str] = (), last: int | None = None) -> None:
    """Merge the folders of all batches up to ``last`` into one that bears its number."""
    _finish(spark, path)
    _, batches, _, _ = _folders(spark, path)
    old = [n for n in batches if last is None or n <= last]
    if len(old) < 2:
        return
    rows = merge(read(spark, path).filter(F.col("batch") <= max(old)).drop("batch"))
    writer = _whole(rows)
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{MERGED}{max(old)}")
    _finish(spark, path)
