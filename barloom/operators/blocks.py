"""Ordered work over long series, cut into bounded pieces.

A window partitioned by ticker alone puts the whole history of a ticker into one task, and one ticker may
hold a third of all rows. Two helpers avoid that:

* ``place`` serves bounded look-back (rolling means, lag, exponential means): every series is cut into blocks
  of ``block_rows`` rows, and each block also receives the ``lookback`` rows before it. Work inside
  (key, block) then equals work over the whole series, and no task sees more than one block of a key.
* ``running`` serves unbounded look-back (running sum, peak, product, last value): a scan inside
  (key, chunk), a scan over one summary row per (key, chunk), and a join of the two.

A chunk is a slice of the order axis known without counting: the calendar year of the order column unless the
caller gives another expression. Daily bars have at most 366 rows per key and year; finer bars want finer chunks, so that a chunk
holds fewer rows of a key than a block. A chunk must rise with the order. Order columns must be
unique within a key and not null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.sources.tables import stage

BLOCK_ROWS = 8192
#: Rows that one task of ``place`` or ``running`` sorts, so that its memory stays the same when the input grows.
TASK_ROWS = 250_000
#: Rows up to which a table of blocks or chunks may be broadcast; its packed files hide how large it is in memory.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Placed:
    """Rows placed in blocks; ``finish`` drops the borrowed look-back rows again."""

    df: DataFrame
    keys: tuple[str, ...]
    order: str
    rows: int  # most rows of a block, with the borrowed ones

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "_blk").orderBy(self.order)

    def last(self, rows: int) -> WindowSpec:
        """Frame of the current row and the ``rows - 1`` before it."""
        return self.window.rowsBetween(-(rows - 1), 0)

    def with_df(self, df: DataFrame) -> "Placed":
        return Placed(df, self.keys, self.order, self.rows)

    def with_columns(self, columns: dict[str, Column]) -> "Placed":
        return self.with_df(self.df.withColumns(columns))

    def finish(self, *drop: str) -> DataFrame:
        return self.df.filter("_own").drop("_blk", "_n", "_pos", "_own", *drop)


def _tasks(df: DataFrame, rows: int | None) -> int:
    return max(-(-(rows or 0) // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)


def joinable(summary: DataFrame, rows: int) -> DataFrame:
    """A staged table of so many rows, to be joined by shuffle where it is too large to broadcast."""
    return summary if rows <= BROADCAST_ROWS else summary.hint("merge")


def place(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lookback: int,
    block_rows: int = BLOCK_ROWS,
    chunk: Column | None = None,
) -> Placed:
    """Cut each series into blocks with ``lookback`` borrowed rows.

    Adds ``_blk``, ``_n`` (position in the block, from 1), ``_pos`` (position in the whole series, from 0) and ``_own`` (false for
    borrowed rows).
    Costs one shuffle of the rows by (key, block). The placement table has one row per (key, chunk, block) and is staged, so the
    planner may broadcast it when it is small, and joins it by shuffle when it is not. It tells the longest series and the number of rows, and so of tasks: one
    per ``TASK_ROWS`` rows, as adaptive execution would merge them by their packed size, which says little of the memory that a sort takes.
    """
    keys = list(keys)
    tagged = df.withColumn("_chunk", F.year(order) if chunk is None else chunk)
    counted = tagged.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    homes = counted.select(
        *keys,
        "_chunk",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"),
        F.sum("_n").over(of_key).alias("_total"),
    ).select(
        *keys,
        "_chunk",
        "_n",
        "_first",
        "_total",
        F.explode(
            F.sequence(
                F.expr(f"_first div {block_rows}"),
                F.expr(f"least((_first + _n - 1 + {lookback}) div {block_rows}, (_total - 1) div {block_rows})"),
            )
        ).alias("_blk"),
    )
    homes = stage(homes, "homes")
    rows, longest, places = homes.agg(F.sum("_n"), F.max("_total"), F.count(F.lit(1))).first()
    homes = joinable(homes.drop("_n", "_total"), places)
    group = Window.partitionBy(*keys, "_blk")
    # An outer join can only broadcast the placement table, never the rows; conditions below are null-safe so that it stays one. The
    # explicit shuffle splits a key's blocks even where the
    # rows arrive partitioned by key alone, which a window over (key, block) would otherwise accept.
    placed = (
        tagged.join(homes, [*keys, "_chunk"], "left")
        .repartition(_tasks(df, rows), *keys, "_blk")
        .withColumn("_n", F.row_number().over(group.orderBy(order)))
        .withColumn("_pos", F.min("_first").over(group) + F.col("_n") - 1)
        .withColumn("_own", F.expr(f"_pos div {block_rows} <=> _blk"))
        .filter(F.coalesce(F.col("_pos").between(F.col("_blk") * block_rows - lookback, (F.col("_blk") + 1) * block_rows - 1), F.lit(False)))
        .drop("_chunk", "_first")
    )
    return Placed(placed, tuple(keys), order, min(block_rows + lookback, longest or 0))


@dataclass(frozen=True)
class Scan:
    """One running value: what to fold, and whether the current row counts."""

    kind: str
    value: Column
    inclusive: bool = True

    def before(self) -> "Scan":
        return Scan(self.kind, self.value, False)


def total(value: Column) -> Scan:
    return Scan("total", value)


def peak(value: Column) -> Scan:
    return Scan("peak", value)


def product(value: Column) -> Scan:
    return Scan("product", value)


def latest(value: Column) -> Scan:
    """Last value that is not null."""
    return Scan("latest", value)


def _over(kind: str, value: Column, frame: WindowSpec) -> Column:
    if kind == "latest":
        return F.last(value, ignorenulls=True).over(frame)
    fold = {"total": F.sum, "peak": F.max, "product": F.product}[kind]
    return fold(value).over(frame)


def _whole(kind: str, value: Column, order: Sequence[str]) -> Column:
    if kind == "latest":
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return {"total": F.sum, "peak": F.max, "product": F.product}[kind](value)


def _joined(kind: str, carried: Column, local: Column) -> Column:
    if kind == "latest":
        return F.coalesce(local, carried)
    if kind == "peak":
        return F.greatest(carried, local)
    both = carried + local if kind == "total" else carried * local
    return F.coalesce(both, carried, local)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    scans: dict[str, Scan],
    chunk: Column | None = None,
) -> DataFrame:
    """Add one running column per scan, over the whole series of each key.

    The summary of the chunks is staged; it tells the number of rows, and so of tasks, as in ``place``.
    """
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order)
    tagged = df.withColumn("_chunk", F.year(order[0]) if chunk is None else chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    frames = {True: inside.rowsBetween(Window.unboundedPreceding, 0), False: inside.rowsBetween(Window.unboundedPreceding, -1)}
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = tagged.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"), *[_whole(s.kind, s.value, order).alias(f"_s_{n}") for n, s in scans.items()]
    )
    carried = stage(
        summary.select(*keys, "_chunk", "_rows", *[_over(s.kind, F.col(f"_s_{n}"), earlier).alias(f"_c_{n}") for n, s in scans.items()]), "carried"
    )
    rows, chunks = carried.agg(F.sum("_rows"), F.count(F.lit(1))).first()
    tagged = tagged.repartition(_tasks(df, rows), *keys, "_chunk")
    local = tagged.withColumns({f"_l_{n}": _over(s.kind, s.value, frames[s.inclusive]) for n, s in scans.items()})
    # summing sums widens a decimal until Spark drops digits, so the carried part keeps the type of the local one; only sums do, and a
    # staged struct must not be cast, as its fields may be null and those of the local one may not
    types = {f.name: f.dataType for f in local.schema.fields}
    carried = joinable(carried.drop("_rows"), chunks).withColumns(
        {f"_c_{n}": F.col(f"_c_{n}").cast(types[f"_l_{n}"]) for n, s in scans.items() if s.kind == "total"}
    )
    out = local.join(carried, [*keys, "_chunk"], "left").withColumns(  # outer, so that the rows are never broadcast
        {n: _joined(s.kind, F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, s in scans.items()}
    )
    return out.drop("_chunk", *[f"_l_{n}" for n in scans], *[f"_c_{n}" for n in scans])
