"""Hard negatives: stored angles to reference directions bound each score, and only rows whose bounds meet a window are scored in integers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import columns, map_batches, stage

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: Reference directions, chosen from so many rows of least hash: that sample only steers how tight the bounds are.
REFERENCES, SAMPLE_ROWS = 8, 4096
#: Rows of a block of anchors and of a block of candidates.
ANCHOR_BLOCK, ROW_BLOCK = 256, 4096
#: Added to a cosine bound: far more than angles lose to rounding.
MARGIN = 1e-6
PLACE = ["dim", "label", "cell", "part"]
ROWS = "array<struct<ids: array<bigint>, codes: array<int>, norm: double, angles: array<double>>>"


def window_of(score: int) -> tuple[int, int]:
    """Least and greatest negative score that a positive of ``score`` allows: from three to nine tenths of it."""
    return -(-3 * score // 10), 9 * score // 10


def references(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Up to ``count`` unit rows of the sample, each the one farthest in angle from those before it."""
    size = np.linalg.norm(sample, axis=1)
    unit = sample[size > 0] / size[size > 0, None]
    chosen: list[int] = []
    nearest = np.full(len(unit), -2.0)
    while len(chosen) < min(count, len(unit)):
        best = int(np.argmin(nearest))
        if chosen and nearest[best] > 1 - 1e-9:
            break
        chosen.append(best)
        nearest = np.maximum(nearest, unit @ unit[best])
    return unit[chosen]


def angles_to(codes: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norm, angle to each direction) per row; a zero row is at a right angle to all."""
    norm = np.sqrt((codes.astype(np.float64) ** 2).sum(axis=1))
    cosine = codes @ directions.T / np.where(norm == 0, 1, norm)[:, None]
    return norm, np.arccos(np.clip(cosine, -1, 1))


class Block:
    """Rows of one label: ids that share a vector, integer vectors, norms and stored angles."""

    def __init__(self, cell: pa.StructScalar):
        held = cell.values
        self.ids = held.field("ids").to_pylist()
        n = len(self.ids)
        self.codes = held.field("codes").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.norm = held.field("norm").to_numpy(zero_copy_only=False)
        self.angles = held.field("angles").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        if not self.codes.size or self.codes.shape[1] * float(np.abs(self.codes).max()) ** 2 < 2**53:
            self.exact = self.codes.astype(np.float64)  # products and their sums are whole numbers below 2**53
        else:
            self.exact = self.codes.astype(np.int64)


def bounds(anchors: Block, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score between each anchor and each row. By the triangle inequality on the sphere their angle is at least the
    difference of their angles to any reference, and at most the sum and what the sum leaves of a full turn."""
    shape = len(anchors.ids), len(rows.ids)
    least, most = np.zeros(shape), np.full(shape, np.pi)
    for r in range(anchors.angles.shape[1]):
        a, c = anchors.angles[:, r, None], rows.angles[None, :, r]
        np.maximum(least, np.abs(a - c), out=least)
        total = a + c
        np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
    size = anchors.norm[:, None] * rows.norm[None, :]
    return np.floor(size * (np.cos(most) - MARGIN)), np.ceil(size * (np.cos(least) + MARGIN))


def scores(anchors: Block, at: int, rows: Block, near: np.ndarray) -> np.ndarray:
    """Whole-number inner products of one anchor with some rows."""
    if anchors.exact.dtype == rows.exact.dtype == np.float64 and anchors.codes.shape[1] * float(np.abs(anchors.codes).max(initial=0)) * float(np.abs(rows.codes).max(initial=0)) < 2**53:
        return (rows.exact[near] @ anchors.exact[at]).astype(np.int64)
    return rows.codes[near].astype(np.int64) @ anchors.codes[at].astype(np.int64)


def merged(best: list[tuple[int, int]], found: np.ndarray, near: np.ndarray, rows: Block, own: int, top: int) -> list[tuple[int, int]]:
    """``best`` (-score, id) with the best of the rows ``near``; all rows that tie with the last place are looked at."""
    if len(found) > top + 1:
        edge = np.partition(found, len(found) - top - 1)[len(found) - top - 1]
        near, found = near[found >= edge], found[found >= edge]
    fresh = [(-s, i) for s, j in zip(found.tolist(), near.tolist(), strict=True) for i in rows.ids[j] if i != own]
    return sorted(best + fresh)[:top]


class PositiveSearch:
    """The best rows of the anchors' own label."""

    schema = "anchor_id bigint, positive_id bigint, positive_score bigint"

    def __init__(self, anchors: Block, asked: list):
        self.anchors, self.best = anchors, [[] for _ in anchors.ids]

    def meet(self, rows: Block) -> None:
        low, high = bounds(self.anchors, rows)
        # the anchor itself may take a place
        keep = POSITIVES + 1
        edge = np.partition(low, -keep, axis=1)[:, -keep] if low.shape[1] > keep else np.full(len(low), -np.inf)
        for at, best in enumerate(self.best):
            limit = max(edge[at], -best[-1][0]) if len(best) == POSITIVES else edge[at]
            near = np.flatnonzero(high[at] >= limit)
            if len(near):
                self.best[at] = merged(best, scores(self.anchors, at, rows, near), near, rows, self.anchors.ids[at][0], POSITIVES)

    def rows(self) -> list[tuple]:
        return [(ids[0], i, -s) for ids, best in zip(self.anchors.ids, self.best, strict=True) for s, i in best]


class NegativeSearch:
    """For each positive of an anchor, the best rows of other labels inside its window."""

    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"

    def __init__(self, anchors: Block, asked: list):
        self.anchors = anchors
        self.asked = [[(p["id"], p["score"], *window_of(p["score"]), []) for p in own] for own in asked]

    def meet(self, rows: Block) -> None:
        low, high = bounds(self.anchors, rows)
        for at, asked in enumerate(self.asked):
            # below this a score is under the window, or not among the best, of every positive
            floor = min(max(least, -best[-1][0]) if len(best) == NEGATIVES else least for _, _, least, _, best in asked)
            near = np.flatnonzero((high[at] >= floor) & (low[at] <= max(most for _, _, _, most, _ in asked)))
            if not len(near):
                continue
            found = scores(self.anchors, at, rows, near)
            own = self.anchors.ids[at][0]
            for n, (p, score, least, most, best) in enumerate(asked):
                inside = (found >= least) & (found <= most)
                if inside.any():
                    asked[n] = p, score, least, most, merged(best, found[inside], near[inside], rows, own, NEGATIVES)

    def rows(self) -> list[tuple]:
        return [(ids[0], p, score, i, -s) for ids, asked in zip(self.anchors.ids, self.asked, strict=True) for p, score, _, _, best in asked for s, i in best]


def _search(tiles: DataFrame, kind: type) -> DataFrame:
    """Tiles (number, asked, anchors, rows), each a block of anchors with a block of rows, to the best rows a task has seen."""
    names = [c.split()[0] for c in kind.schema.split(", ")]

    def out(search) -> pa.RecordBatch:
        found = search.rows()
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(len(names))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, object] = {}
        for batch in batches:
            number, asked, anchors, rows = batch.columns
            for at in range(batch.num_rows):
                key = number[at].as_py()
                if key not in open_:
                    if len(open_) >= 8:
                        yield out(open_.pop(next(iter(open_))))
                    open_[key] = kind(Block(anchors[at]), asked[at].as_py())
                open_[key].meet(Block(rows[at]))
        for search in open_.values():
            yield out(search)

    return map_batches(tiles, run, kind.schema)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, shift_every: int, labels: int) -> DataFrame:
    """(id, label, codes): one row per id, whole-number vectors, labels moved on by one where the id is divisible by ``shift_every``."""
    named = columns(vectors, id_col, label_col, vector_col).toDF("id", "label", "raw")
    fits = "forall(raw, x -> x is not null and not isnan(x) and abs(256 * double(x)) <= least(2147483647, floor(sqrt(9.2e18 / size(raw)))))"
    whole = named.where(f"id is not null and label is not null and raw is not null and (size(raw) = 0 or {fits})")
    moved = F.expr(f"case when id % {shift_every} = 0 then (label + 1L) % {labels} else bigint(label) end")
    coded = whole.select("id", F.struct(moved.alias("label"), F.expr("transform(raw, x -> int(floor(256 * double(x))))").alias("codes")).alias("row"))
    return coded.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*")


def _placed(rows: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """Rows (label, codes, ids) with norm, angles and the nearest reference as ``cell``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, angles, cells = [], [], []
            for codes in batch.column(1).to_pylist():
                to = directions.get(len(codes))
                if to is None or not len(to):
                    norm, angle = float(np.sqrt(sum(float(c) ** 2 for c in codes))), []
                else:
                    n, a = angles_to(np.array([codes], np.float64), to)
                    norm, angle = float(n[0]), a[0].tolist()
                norms.append(norm)
                angles.append(angle)
                cells.append(min(range(len(angle)), key=angle.__getitem__) if angle else 0)
            added = [pa.array(norms, pa.float64()), pa.array(angles, pa.list_(pa.float64())), pa.array(cells, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], ["label", "codes", "ids", "norm", "angles", "cell"])

    schema = "label bigint, codes array<int>, ids array<bigint>, norm double, angles array<double>, cell int"
    return map_batches(rows.select("label", "codes", "ids"), measure, schema).withColumn("dim", F.size("codes"))


def _blocks(placed: DataFrame, size: int, name: str, *more: Column) -> DataFrame:
    """Blocks of about ``size`` rows near one reference, with the ranges of their norms and angles."""
    counts = stage(placed.groupBy("dim", "label", "cell").agg(F.expr(f"count(*) div {size}").alias("last")), f"{name}-counts")
    dealt = placed.join(counts, ["dim", "label", "cell"]).withColumn("part", F.expr("pmod(xxhash64(ids), 1 + last)"))
    spread = [f(F.get("angles", r)).alias(f"_{n}{r}") for r in range(REFERENCES) for n, f in (("least", F.min), ("most", F.max))]
    made = dealt.groupBy(*PLACE).agg(
        F.collect_list(F.struct("ids", "codes", "norm", "angles")).alias("rows"), F.min("norm").alias("norm_least"), F.max("norm").alias("norm_most"), *spread, *more
    )
    ends = {n: F.array_compact(F.array(*[F.col(f"_{n}{r}") for r in range(REFERENCES)])) for n in ("least", "most")}
    made = made.withColumns({f"angle_{n}": c for n, c in ends.items()}).drop(*[f"_{n}{r}" for r in range(REFERENCES) for n in ends])
    return stage(made.withColumn("number", F.xxhash64(*PLACE)), f"{name}-blocks")


def _overlap(a: str, c: str) -> Column:
    """Whether some anchor of a block and some row of another may have a score in the block's windows."""
    gaps = F.zip_with(F.arrays_zip(f"{a}.angle_least", f"{a}.angle_most"), F.arrays_zip(f"{c}.angle_least", f"{c}.angle_most"), lambda x, y: F.greatest(x["angle_least"] - y["angle_most"], y["angle_least"] - x["angle_most"]))
    sums = F.zip_with(F.col(f"{a}.angle_most"), F.col(f"{c}.angle_most"), lambda x, y: x + y)
    least, most = F.greatest(F.lit(0.0), F.array_max(gaps)), F.least(F.lit(float(np.pi)), F.array_min(sums))

    def reach(cosine: Column, positive: str, negative: str) -> Column:
        one, other = (F.col(f"{a}.norm_{n}") * F.col(f"{c}.norm_{n}") for n in (positive, negative))
        return cosine * F.when(cosine > 0, one).otherwise(other)

    high, low = reach(F.cos(least) + MARGIN, "most", "least"), reach(F.cos(most) - MARGIN, "least", "most")
    return (high + 1 >= F.col(f"{a}.low")) & (low - 1 <= F.col(f"{a}.high"))


def _tiles(anchors: DataFrame, rows: DataFrame, same_label: bool) -> DataFrame:
    """Pairs of blocks that must meet. The pairs are formed from the blocks' ranges alone, dealt over slots; vectors travel only for pairs that are left."""
    slots = 1 + rows.count() // 64
    summary = ["number", "dim", "label", "norm_least", "norm_most", "angle_least", "angle_most"]
    on = ["dim", "slot"] + ["label"] * same_label
    left = anchors.select(*summary, *([] if same_label else ["low", "high"]), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")).alias("a")
    right = rows.select(*summary, F.expr(f"int(pmod(number, {slots}))").alias("slot")).alias("c")
    pairs = left.join(right, on)
    if not same_label:
        pairs = pairs.where((F.col("a.label") != F.col("c.label")) & _overlap("a", "c"))
    pairs = stage(pairs.select(F.col("a.number").alias("number"), F.col("c.number").alias("other")), "pairs")
    asked = anchors.select("number", "asked", F.col("rows").alias("anchors"))
    return pairs.join(asked, "number").join(rows.select(F.col("number").alias("other"), "rows"), "other").select("number", "asked", "anchors", "rows")


def mine(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = EVERY,
    shift_every: int = 7,
    labels: int = 10,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. A component x counts as floor(256 x), and a score is the whole-number inner
    product. An anchor's positives are its five best other rows of its label; for each, the ten best rows of other labels with a score from three
    to nine tenths of the positive's come out, ties by the smaller id. Where the positive's score is negative no score satisfies both ends.
    Exact: references and blocks only decide which scores need not be computed.

    Null ids, labels, vectors and vectors with a null or non-finite component take no part, nor do vectors whose inner products might not
    fit a long. Rows repeated under one id count once, and of different rows under one id only the least by (label, vector) counts. Vectors of different
    lengths do not meet. A label with one row has no positives. An empty table gives no rows. Rows that share label and vector are one candidate with
    its smallest ids, as many as could be needed, so a vector that very many rows share costs one score.
    """
    coded = stage(usable(vectors, id_col, vector_col, label_col, shift_every, labels), "coded")
    sample = coded.select("codes").distinct().orderBy(F.xxhash64("codes"), "codes").limit(SAMPLE_ROWS).collect()
    by_dim: dict[int, list] = {}
    for (codes,) in sample:
        by_dim.setdefault(len(codes), []).append(codes)
    directions = {d: references(np.array(v, np.float64).reshape(len(v), d)) for d, v in by_dim.items()}

    ranked = coded.withColumn("n", F.row_number().over(Window.partitionBy("label", "codes").orderBy("id"))).where(f"n <= {NEGATIVES + 1}")
    shared = ranked.groupBy("label", "codes").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    rows = _blocks(_placed(stage(shared, "shared"), directions), ROW_BLOCK, "row")
    asked = stage(_placed(coded.where(f"id % {every} = 0").withColumn("ids", F.array("id")), directions), "anchors")

    nothing = F.lit(None).cast("array<array<struct<id: bigint, score: bigint>>>").alias("asked")
    first = _blocks(asked, ANCHOR_BLOCK, "first", F.first(nothing).alias("asked"))
    found = _search(_tiles(first, rows, True), PositiveSearch)
    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    positives = found.withColumn("n", F.row_number().over(best)).where(f"n <= {POSITIVES}")
    own = positives.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("own"))

    # windows of an anchor as doubles, wide enough for any rounding
    with_own = asked.join(stage(own, "positives"), F.col("anchor_id") == F.get("ids", F.lit(0)))
    ends = [F.transform("own", lambda p: p["score"] * F.lit(x)) for x in (0.3, 0.9)]
    with_own = stage(with_own.withColumns({"low": F.array_min(ends[0]) - 1, "high": F.array_max(ends[1]) + 1}), "asking")
    second = _blocks(with_own, ANCHOR_BLOCK, "second", F.collect_list("own").alias("asked"), F.min("low").alias("low"), F.max("high").alias("high"))
    negatives = _search(_tiles(second, rows, False), NegativeSearch)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    out = negatives.withColumn("rank", F.row_number().over(order)).where(f"rank <= {NEGATIVES}")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
