"""Nearest neighbours by a block matrix join: int8 products with error bounds, then exact distances of what survives."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import columns, map_batches, stage

TOP, EVERY = 10, 100
#: Rows of a block of queries and of a block of candidates.
QUERY_BLOCK, ROW_BLOCK = 512, 8192


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale per row, length of what each row loses): vectors = codes * scale + error, |error| as returned."""
    scale = np.abs(vectors).max(axis=1) / 127
    scale[scale == 0] = 1
    codes = np.rint(vectors / scale[:, None])
    return codes.astype(np.int8), scale, np.linalg.norm(vectors - codes * scale[:, None], axis=1)


def tile_bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance between each row of two quantised blocks.

    The product of int8 codes is exact: float32 while its sums stay below 2**24, float64 beyond. The distance of the quantised
    vectors differs from the true one by at most the two rows' errors; a margin covers rounding.
    """
    (a, sa, ea), (b, sb, eb) = q, c
    kind = np.float32 if a.shape[1] * 127 * 127 < 2**24 else np.float64
    product = (a.astype(kind) @ b.astype(kind).T).astype(np.float64) * sa[:, None] * sb[None, :]
    na, nb = (((x.astype(np.float64) ** 2).sum(axis=1) * s**2) for x, s in ((a, sa), (b, sb)))
    size = na[:, None] + nb[None, :]
    squared = size - 2 * product
    slack = size * 1e-12
    error = ea[:, None] + eb[None, :]
    low = np.sqrt(np.maximum(squared - slack, 0)) - error
    return low * (1 - 1e-9), (np.sqrt(np.maximum(squared + slack, 0)) + error) * (1 + 1e-9)


class Block:
    """Vectors with the ids that share each of them, the smallest first."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids, self.codes = vectors, ids, quantise(vectors)


def nearest_in_tile(queries: Block, rows: Block, found: list[list[tuple[float, int]]], top: int) -> None:
    """Merge a tile into ``found``, for each query a heap of its best (-distance, -id).

    A pair survives when its least distance is not over the query's ``top``-th smallest greatest distance in the tile, nor over the worst
    distance in a full heap. Survivors get the distance of the original vectors. A vector's ids beyond top + 1 cannot be among the best.
    """
    low, high = tile_bounds(queries.codes, rows.codes)
    keep = min(top + 1, high.shape[1])  # one place may be taken by the query's own vector
    edge = np.partition(high, keep - 1, axis=1)[:, keep - 1] if high.shape[1] > keep else np.full(len(high), np.inf)
    for i, heap in enumerate(found):
        limit = min(edge[i], -heap[0][0]) if len(heap) == top else edge[i]
        own = queries.ids[i][0]
        near = np.flatnonzero(low[i] <= limit)
        gap = rows.vectors[near] - queries.vectors[i]
        exact = np.sqrt(np.add.accumulate(gap * gap, axis=1)[:, -1])  # summed from the first component on, as a plain loop does
        for d, j in zip(exact.tolist(), near.tolist(), strict=True):
            for other in rows.ids[j]:
                if other == own:
                    continue
                entry = (-d, -other)
                if len(heap) < top:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                else:
                    break


def _blocks(vectors: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows (dim, v, ids) gathered into blocks (dim, block, rows) of about ``size`` rows, dealt by a hash of the vector; and the last
    block of each dim."""
    last = stage(vectors.groupBy("dim").agg(F.expr(f"count(*) div {size} as last")), f"{name}-dims")
    dealt = vectors.join(last, "dim").withColumn("block", F.expr("pmod(xxhash64(v, ids), 1 + last)"))
    return stage(dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("ids", "v")).alias("rows")), f"{name}-blocks"), last


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, every: int = EVERY) -> DataFrame:
    """(query_id, rank, <id>, score): the ``top`` rows nearest to each row whose id is divisible by ``every``, by Euclidean distance.

    Exact: bounds only decide which distances need not be computed. Ties go to the smaller id. All rows but those with the query's id
    are candidates, and fewer than ``top`` candidates give fewer rows. Rows with the same id and vector count once; an id with two
    vectors is two candidates and, as a query, takes the best of both. Null ids, vectors that are null, empty or zero, and vectors with
    a null or non-finite component take no part; vectors of different lengths are not compared. An empty table gives no rows.

    Equal vectors are one candidate with its top + 1 smallest ids, so a vector that very many rows share costs one distance. Each block
    of candidates is sent to each block of queries: that is the stated query set against all rows, in blocks of bounded size.
    """
    usable = columns(vectors, id_col, vector_col).toDF("id", "raw").where(
        "id is not null and size(raw) > 0 and forall(raw, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(raw, x -> x != 0)"
    )
    # adding zero makes negative zeros plain, so that equal vectors are equal as values
    plain = usable.selectExpr("id", "transform(raw, x -> double(x) + 0.0D) as v").distinct()
    first = Window.partitionBy("v").orderBy("id")
    ranked = plain.withColumn("n", F.row_number().over(first)).where(f"n <= {top + 1}")
    shared = ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).selectExpr("size(v) as dim", "v", "ids")
    rows, last = _blocks(stage(shared, "vectors"), ROW_BLOCK, "row")
    asked = plain.where(f"id % {every} = 0").selectExpr("size(v) as dim", "v", "array(id) as ids")
    queries, _ = _blocks(stage(asked, "queries"), QUERY_BLOCK, "query")
    # every block of queries once for each block of rows; a pair of blocks meets by equality
    sent = queries.join(last, "dim").selectExpr("dim", "block as number", "rows as queries", "explode(sequence(0L, last)) as block")
    tiles = rows.join(sent, ["dim", "block"]).select("dim", "number", "queries", "rows")

    def block_of(cell) -> Block:
        held = cell.values
        ids, flat = held.field("ids").to_pylist(), held.field("v").flatten().to_numpy(zero_copy_only=False)
        return Block(flat.reshape(len(ids), -1), ids)

    def run(batches):
        found: dict[tuple[int, int], tuple[Block, list]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                key = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                if key not in found:
                    if len(found) >= 4:
                        yield best(*found.pop(next(iter(found))))
                    block = block_of(batch.column(2)[at])
                    found[key] = block, [[] for _ in block.ids]
                nearest_in_tile(found[key][0], block_of(batch.column(3)[at]), found[key][1], top)
        for held in found.values():
            yield best(*held)

    def best(block: Block, heaps: list) -> pa.RecordBatch:
        out = [(ids[0], -i, -d) for ids, heap in zip(block.ids, heaps, strict=True) for d, i in heap]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "id", "score"])

    near = map_batches(tiles, run, "query_id bigint, id bigint, score double").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "id")
    merged = near.withColumn("rank", F.row_number().over(order)).where(f"rank <= {top}")
    return merged.select("query_id", "rank", F.col("id").alias(id_col), "score")
