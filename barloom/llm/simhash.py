"""Near copies by SimHash fingerprints, found through deletion variants of the fingerprints' halves."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import columns, map_batches, small_batches, stage
from barloom.llm.components import roots

BITS, DISTANCE, SEED, WORDS = 64, 3, 42, 3
#: A bucket up to this size is compared within one task; members of a larger one are indexed again by the quarters of their other half.
BUCKET = 16_384
#: Runs over this size, at most 2**18 after the second index, look up all neighbours within the distance instead of comparing pairs.
PAIRS = 32_768


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned integer: a bit is set where over half of the shingles' hashes have it."""
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined, digest = b" ".join(found), xxhash.xxh64_digest
    if len(found) < words:
        hashes = digest(joined, seed)
    else:
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = b"".join([digest(joined[a:b], seed) for a, b in spans])
    rows = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(rows), 1 << 16):
        counts += np.unpackbits(rows[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(rows)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row, fp as a signed 64-bit integer."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], [id_col, "fp"])

    return map_batches(columns(docs, id_col, text_col), run, f"`{id_col}` {kind}, fp bigint")


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` with the sets of a[i] and b[i] joined; every entry points straight to the least index of its set."""
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        if (low == high).all():
            return parent
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]


def sets_in_runs(run: np.ndarray, prints: np.ndarray, distance: int = DISTANCE, pairs: int = PAIRS) -> np.ndarray:
    """For rows sorted by run: the least row of the same run that links lead to."""
    n = len(run)
    parent = np.arange(n)
    edges = np.flatnonzero(np.diff(run)) + 1
    begins, ends = np.concatenate(([0], edges)), np.concatenate((edges, [n]))
    large = np.repeat(ends - begins > pairs, ends - begins)
    active = np.flatnonzero(~large)
    offset = 1
    while len(active):
        active = active[active + offset < n]
        active = active[run[active] == run[active + offset]]
        apart = active[parent[active] != parent[active + offset]]
        near = apart[np.bitwise_count(prints[apart] ^ prints[apart + offset]) <= distance]
        if len(near):
            parent = _merge(parent, near, near + offset)
        offset += 1
    for begin, end in zip(begins, ends, strict=True):
        if end - begin > pairs:
            own = np.sort(prints[begin:end])
            place = begin + np.argsort(prints[begin:end])
            varied = int(np.bitwise_or.reduce(own ^ own[0]))
            bits = [1 << i for i in range(BITS) if varied >> i & 1]
            for size in range(1, distance + 1):
                for chosen in combinations(bits, size):
                    other = own ^ np.uint64(sum(chosen))
                    at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    hit = np.flatnonzero(own[at] == other)
                    parent = _merge(parent, place[hit], place[at[hit]])
    return parent


def _linked(batches, keys: int):
    """(a, b) that connect the linked fingerprints of each key, from batches sorted by key; a key may cross batches."""

    def flush(columns_):
        *by, prints = columns_
        change = np.zeros(len(prints), dtype=bool)
        for k in by:
            change[1:] |= k[1:] != k[:-1]
        parent = sets_in_runs(np.cumsum(change), prints)
        moved = np.flatnonzero(parent != np.arange(len(parent)))
        return pa.RecordBatch.from_arrays([pa.array(prints[moved].view(np.int64)), pa.array(prints[parent[moved]].view(np.int64))], ["a", "b"])

    rest = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        now[keys] = now[keys].view(np.uint64)
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        n = len(now[keys])
        if not n:
            continue
        last = np.ones(n, dtype=bool)
        for k in now[:keys]:
            last &= k == k[-1]
        cut = int(np.argmax(last))
        rest = [x[cut:] for x in now]
        if cut:
            yield flush([x[:cut] for x in now])
    if rest is not None:
        yield flush(rest)


def _buckets(df: DataFrame, by: list[str]) -> DataFrame:
    """Links within the keys ``by`` of rows (by..., fp); every key is small enough for one task."""
    keys = len(by)
    ordered = df.select(*by, "fp").repartition(*by).sortWithinPartitions(*by, "fp")
    return map_batches(ordered, lambda batches: _linked(batches, keys), "a bigint, b bigint")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) that connect all of the distinct fingerprints ``fp`` that differ in at most three bits, possibly through others.

    Of two halves, one differs in at most one bit. So each fingerprint is filed under each half with each of its 32 bits blanked, and
    linked ones meet under at least one key. Keys with one member are dropped. Members of a key over ``bucket`` are filed again, by
    the quarters of the half that the key leaves open, with each bit blanked; at most 18 bits stay open there, so a second key has at
    most 2**18 members. Every meeting is verified on all bits.
    """
    half = "case when k < 32 then fp & 4294967295 else shiftrightunsigned(fp, 32) end"
    filed = prints.select("fp", F.explode(F.expr("sequence(0, 63)")).alias("k")).selectExpr(
        "fp", "k", f"shiftleft(cast(k as bigint), 32) | (({half}) & ~shiftleft(1L, k % 32)) as key"
    )
    # both sides grow with the fingerprints, so neither is broadcast
    sizes = filed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = stage(filed.join(stage(sizes, "keys").hint("merge"), "key"), "meetings")
    small, large = met.where(F.col("members") <= bucket), met.where(F.col("members") > bucket)
    open_half = "case when k < 32 then shiftrightunsigned(fp, 32) else fp & 4294967295 end"
    quarter = "case when q < 16 then open & 65535 else shiftrightunsigned(open, 16) end"
    again = (
        large.selectExpr("key", "fp", f"{open_half} as open")
        .select("key", "fp", "open", F.explode(F.expr("sequence(0, 31)")).alias("q"))
        .selectExpr("key", "fp", f"shiftleft(cast(q as bigint), 16) | (({quarter}) & ~shiftleft(1L, q % 16)) as part")
    )
    return _buckets(small, ["key"]).unionAll(_buckets(again, ["key", "part"])).distinct()


def _groups(prints: DataFrame, id_col: str, bucket: int) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of staged rows (id, fp)."""
    least = stage(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "prints")
    star = roots(links(least.select("fp"), bucket))
    rooted = least.join(star.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage(rooted, "rooted")
    smallest = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    return stage(rooted.join(smallest, "root").select("fp", "root", "component_id"), "groups")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(id, fingerprint, component_id) per row; component_id is the smallest id that links of up to three differing bits lead to.

    A null text counts as empty; texts without a word have fingerprint zero and link like any other. Whole texts are read. Repeated
    rows each return their row. A null id is returned as null and never becomes a component_id while the component has another id.
    An empty table gives no rows. Other columns are not read.
    """
    prints = stage(with_fingerprint(docs, id_col, text_col), "fingerprints")
    groups = _groups(prints, id_col, bucket).select("fp", "component_id")
    return prints.join(groups, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` with one document for each component of near copies, that of the smallest id (a null id comes last).

    Of rows that share this id and the fingerprint, the one with the least text stays. Columns stay as they are.
    """
    names = docs.columns
    at_id, at_text = (F.col(f"row.c{names.index(n)}") for n in (id_col, text_col))
    small_batches(docs.sparkSession)
    of_text = F.pandas_udf(lambda texts: texts.map(fingerprint).astype("uint64").astype("int64"), "bigint")
    row = F.struct(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    # the id as keys without nulls, so that the join and the choice among repeated rows share one shuffle of the rows
    keys = {"no_id": F.col(f"`{id_col}`").isNull(), "id_key": F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))}
    columns_ = [row.alias("row"), of_text(F.col(f"`{text_col}`")).alias("fp"), *[c.alias(n) for n, c in keys.items()]]
    keyed = stage(docs.select(*columns_), "fingerprints")
    prints = keyed.select(at_id.alias("id"), "fp", *keys)
    groups = _groups(prints.select("id", "fp"), "id", bucket).select("fp", "root")
    least = F.min(F.struct("no_id", "id", "fp", "id_key")).alias("least")
    chosen = prints.distinct().join(groups, "fp").groupBy("root").agg(least).select("least.fp", "least.no_id", "least.id_key")
    kept = keyed.join(stage(chosen, "chosen"), ["fp", *keys], "left_semi")
    order = Window.partitionBy("fp", *keys).orderBy(at_text, F.xxhash64("row"))
    one = kept.withColumn("n", F.row_number().over(order)).where("n = 1")
    return one.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)])
