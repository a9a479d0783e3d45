"""Keyed writes as transforms: (target, changes) -> new target.

Plain Parquet tables have no row-level merge, so every function returns the new table, to be written by partition. Changes are reduced
to one row per key first, then the target rows they replace are removed by an anti join: with few changes the planner broadcasts
the changed keys and the target is not shuffled at all. Keys are compared null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.dedupe import latest_per_key


def _without(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``gone``."""
    doomed = gone.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return target.join(doomed, match, "left_anti")


def _matched(target: DataFrame, changes: DataFrame, keys: Sequence[str], how: str, prefix: str = "_c_") -> DataFrame:
    renamed = changes.select(*[F.col(c).alias(f"{prefix}{c}") for c in changes.columns])
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])
    return target.join(renamed, match, how)


def _one_per_key(changes: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """The last change of each key; without an order a key that comes twice is an error when the rows are read."""
    if order:
        return latest_per_key(changes, keys, order).drop(order)
    row = F.struct(*changes.columns)
    single = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.lit("a key is changed more than once and no order is given")))
    return changes.groupBy(*keys).agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_n")).select(single.alias("_row")).select("_row.*")


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order: str | None = None, preserve: Sequence[str] = ()
) -> DataFrame:
    """Changed keys take the new row, all others stay.

    ``order`` picks the last of several changes to a key (without it a repeated key is an error). ``preserve`` names columns that keep
    their old value where the key existed. If a key column is missing from the target, whole rows are merged instead.
    """
    if not set(keys) <= set(target.columns):
        latest = changes.drop(order) if order else changes
        return target.unionByName(latest, allowMissingColumns=True).distinct()
    latest = _one_per_key(changes, keys, order)
    if preserve:
        old = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(p).alias(f"_old_{p}") for p in preserve])
        match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        latest = (
            latest.join(old, match, "left")
            .withColumns({p: F.coalesce(F.col(f"_old_{p}"), F.col(p)) for p in preserve})
            .select(*latest.columns)
        )
    return _without(target, latest, keys).unionByName(latest, allowMissingColumns=True)


def insert_new(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Add rows whose key is absent; of several the first by ``order``."""
    if order:
        from barloom.operators.dedupe import first_per_key

        rows = first_per_key(rows, keys, order).drop(order)
    return target.unionByName(_without(rows, target, keys), allowMissingColumns=True)


def patch(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    cleared: str | None = None,
    stamp: dict[str, Column] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Change single columns of existing rows.

    A null in ``changes`` leaves the column as it is, unless the array column ``cleared`` names it, which sets it to null.
    ``stamp`` columns are set on every row that was changed. Several changes to a key are folded in ``order``: for each column the last
    one that sets or clears it counts. Without an order a repeated key is an error.
    """

    def change(c: str) -> Column:
        """(set, value) of a column that a change touches, else null."""
        wipe = F.coalesce(F.array_contains(F.col(cleared), F.lit(c)), F.lit(False)) if cleared else F.lit(False)
        return F.when(wipe | F.col(c).isNotNull(), F.struct(F.when(~wipe, F.col(c)).alias("v")))

    events = changes.select(*keys, *([order] if order else []), *[change(c).alias(f"_set_{c}") for c in columns])
    if order:
        last = [F.max_by(F.col(f"_set_{c}"), F.when(F.col(f"_set_{c}").isNotNull(), F.col(order))).alias(f"_set_{c}") for c in columns]
        events = events.groupBy(*keys).agg(*last)
    else:
        events = _one_per_key(events, keys, None)
    both = _matched(target, events.withColumn("_hit", F.lit(True)), keys, "left")
    new = {c: F.when(F.col(f"_c__set_{c}").isNotNull(), F.col(f"_c__set_{c}.v")).otherwise(F.col(c)) for c in columns}
    out = both.withColumns(new)
    out = out.withColumns({c: F.when(F.col("_c__hit"), v).otherwise(F.col(c)) for c, v in (stamp or {}).items()})
    return out.select(*target.columns)


def delete(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove the rows of the given keys."""
    return _without(target, gone, keys)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], op: str = "op", order: str = "seq"
) -> DataFrame:
    """Apply a mixed batch: per key only the last change counts; ``D`` removes the row, anything else replaces it."""
    latest = latest_per_key(changes, keys, order)
    kept = latest.filter(F.col(op) != "D").drop(op, order)
    return _without(target, latest, keys).unionByName(kept, allowMissingColumns=True)


def rekey(target: DataFrame, moves: DataFrame, keys: Sequence[str], old: str, new: str, order: str = "seq") -> DataFrame:
    """Move rows to another key: each move deletes the ``old`` key and writes its row under ``new``.

    ``moves`` has the other key columns, ``old``, ``new``, ``order`` and the row's values; ``keys`` names the key column that
    changes last. A move to the same key only updates the values.
    """
    moved = keys[-1]
    values = [c for c in moves.columns if c not in (old, new, order)]
    # the write comes after the delete of the same move
    steps = moves.select(
        *values,
        F.inline(
            F.array(
                F.struct(F.col(old).alias(moved), F.lit("D").alias("op"), (F.col(order) * 2).alias("seq")),
                F.struct(F.col(new).alias(moved), F.lit("U").alias("op"), (F.col(order) * 2 + 1).alias("seq")),
            )
        ),
    )
    return apply_changes(target, steps, keys)


def cascade(
    parents_gone: DataFrame, children: DataFrame, parent_key: str, child_key: str, on_delete: str = "cascade"
) -> DataFrame:
    """Children after their parents were deleted: removed (``cascade``) or with the reference set to null (``set_null``)."""
    gone = parents_gone.select(F.col(parent_key).alias("_gone")).distinct()
    if on_delete == "cascade":
        return children.join(gone, F.col(child_key) == F.col("_gone"), "left_anti")
    marked = children.join(gone, F.col(child_key) == F.col("_gone"), "left")
    return marked.withColumn(child_key, F.when(F.col("_gone").isNull(), F.col(child_key))).drop("_gone")
