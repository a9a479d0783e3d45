"""As-of lookup: for each request the fact of the same day or the last day before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.blocks import latest, running


def backward(
    requests: DataFrame,
    facts: DataFrame,
    on: str,
    keys: Sequence[str] = (),
    strict: bool = False,
    exact: bool = False,
    chunk: Column | None = None,
) -> DataFrame:
    """Requests with the columns of the fact found, and its day as ``fact_<on>``; null where there is none.

    Facts are unique per (keys, on). ``strict`` takes only earlier days, ``exact`` only the same day. Requests and facts are put in one
    ordered series and the last fact is carried along, so no pairs of rows are formed.
    """
    values = [c for c in facts.columns if c not in (*keys, on)]
    if exact:
        same = facts.withColumn(f"fact_{on}", F.col(on))
        return requests.join(same, [*keys, on], "left")
    if not keys:
        # without a key one day may be asked for by very many requests, so each day is looked up once
        days = requests.select(on).distinct().withColumn("_all", F.lit(0))
        found = backward(days, facts.withColumn("_all", F.lit(0)), on, ["_all"], strict, False, chunk)
        return requests.join(found.drop("_all"), on, "left")
    extra = [c for c in requests.columns if c not in (*keys, on)]
    told = facts.withColumn("_fact", F.struct(F.col(on).alias(f"fact_{on}"), *values)).withColumn("_ask", F.lit(None).cast("boolean"))
    asked = requests.withColumn("_ask", F.lit(True)).withColumn("_req", F.struct(*(extra or [on])))
    series = asked.select(*keys, on, "_ask", "_req", F.lit(0 if strict else 1).alias("_turn")).unionByName(
        told.select(*keys, on, "_ask", "_fact", F.lit(1 if strict else 0).alias("_turn")), allowMissingColumns=True
    )
    carried = running(series, keys, [on, "_turn"], {"_found": latest(F.col("_fact"))}, chunk)
    return carried.filter("_ask").select(
        *keys, on, *[F.col(f"_req.{c}").alias(c) for c in extra], *[F.col(f"_found.{c}").alias(c) for c in (f"fact_{on}", *values)]
    )
