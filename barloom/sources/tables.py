"""Plain tables: staging, layout and column conformity."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import merge
from barloom.session import shared_folder


_PASSING = threading.local()  # paths staged inside the innermost ``passing`` of a thread


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside is deleted at the end, so all that reads it must be written by then."""
    outer, _PASSING.paths = getattr(_PASSING, "paths", None), []
    try:
        yield
    finally:
        paths, _PASSING.paths = _PASSING.paths, outer
        for path in paths:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go with the end of the write, instead of when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the plan where several branches read one costly result. The table outlives lost executors, and its known size lets the
    planner choose join strategies from facts.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if getattr(_PASSING, "paths", None) is not None:
        _PASSING.paths.append(path)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows gathered by ``by`` for writing; adaptive execution splits large groups over several tasks and joins small ones."""
    return df.hint("rebalance", *by)


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Overwrite a table. With ``by``, only the partitions present in ``df`` are replaced; :func:`replace` also removes emptied ones."""
    if not by:
        replace(df, path, fmt=fmt)
        return
    (
        spread(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def replace(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Make ``df`` the whole table at ``path``, which ``df`` itself may read.

    The rows are written beside the table, then the folders are swapped and the old one is deleted; a run that fails before the swap
    leaves the table as it was. Partitions without rows in ``df`` are gone, so deletes take effect.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    new, old, at = (hadoop.Path(p) for p in (f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}", path))
    writer = (spread(df, by) if by else df).write.format(fmt)
    (writer.partitionBy(*by) if by else writer).save(new.toString())
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(at) and not files.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, at):
        raise OSError(f"cannot move the new rows to {path}; the old ones are in {old.toString()}")
    files.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def upsert_csv(
    spark: SparkSession, changes: DataFrame, source: str | None, target: str, keys: Sequence[str], sort: Sequence[str] = (), order: str = "seq"
) -> None:
    """Merge changes into a CSV table, the last row of a key winning, and write it sorted descending to ``target``.

    All columns are text, as in the file. ``source`` is the present table, or None for the first write.
    """
    values = [c for c in changes.columns if c != order]
    texts = changes.select(*[F.col(c).cast("string").alias(c) for c in values], F.col(order))
    if source is None:
        merged = merge.upsert(texts.limit(0).drop(order), texts, keys, order=order)
    else:
        merged = merge.upsert(spark.read.option("header", True).csv(source), texts, keys, order=order)
    present = [F.col(c).desc() for c in sort if c in merged.columns]
    write_csv(merged.orderBy(*present) if present else merged, target)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def conform(
    df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None, digits: int | None = None
) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null or their default, nulls defaulted, doubles rounded half-even."""
    defaults = defaults or {}
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        c = F.expr(f"try_cast(`{field.name}` as {field.dataType.simpleString()})") if field.name in present else F.lit(None)
        if digits is not None and isinstance(field.dataType, T.DoubleType):
            c = F.bround(c, digits)
        if field.name in defaults:
            c = F.coalesce(c, defaults[field.name])
        return c.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])
