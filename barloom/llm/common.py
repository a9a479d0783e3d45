"""What the corpus operators share."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import shared_folder

BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe against lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts takes in a worker, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` builds, kept for all tasks of a Python worker; the last four keys stay."""
    store = sys.modules.setdefault("_barloom_worker", types.ModuleType("_barloom_worker")).__dict__.setdefault("kept", {})
    if key not in store:
        while len(store) >= 4:
            store.pop(next(iter(store)))
        store[key] = make()
    return store[key]


def map_batches(df: DataFrame, fn: Callable[[Iterator[Any]], Iterator[Any]], schema: str) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns of any name do no harm."""
    return df.select(*[F.col(f"`{n}`") for n in names])
