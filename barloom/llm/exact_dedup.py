"""Exact copies: static binary fuse filters per immutable snapshot screen incoming digests, positives meet the exact entries and bytes."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import columns, stage

#: Distinct digests a filter is made for, on average; batches that the rows of ``dedupe`` arrive in; digests up to which a list of them is
#: broadcast (32 bytes each, so 8 MB), beyond it rows and list meet by a shuffle.
BUCKET_KEYS, BATCHES, BROADCAST_DIGESTS = 4096, 3, 1 << 18
SALTS = 16


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits of each key, another mixture for each seed."""
    x = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class FuseFilter:
    """A static set of 64-bit keys in about nine bits each: no member is missed, one of 256 others passes.

    Each key has one cell in each of three neighbouring segments, and the exclusive or of the three is its fingerprint. Cells are filled
    in the reverse of an order in which every key is, when its turn comes, alone in some cell.
    """

    def __init__(self, seed: int, segment: int, cells: np.ndarray):
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def _places(hashes: np.ndarray, segment: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.uint64(size // segment - 2)
        low = np.uint64(segment - 1)
        first = ((hashes >> np.uint64(32)) * starts) >> np.uint64(32)
        home = first * np.uint64(segment)
        return (
            (home + (hashes & low)).astype(np.int64),
            (home + np.uint64(segment) + ((hashes >> np.uint64(12)) & low)).astype(np.int64),
            (home + np.uint64(2 * segment) + ((hashes >> np.uint64(22)) & low)).astype(np.int64),
        )

    @staticmethod
    def _marks(hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(17)) ^ (hashes >> np.uint64(41))) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def of(cls, keys: np.ndarray) -> "FuseFilter":
        """The filter of ``keys``; repeated ones count once."""
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        segment = 1 << max(2, min(10, int(math.log(n) / math.log(3.33) + 2.25)))
        spare = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        size = segment * max(3, math.ceil(n * spare / segment))
        seed = 0
        while True:
            hashes = _mixed(keys, seed)
            order = cls._peeled(cls._places(hashes, segment, size), size)
            if order is not None:
                return cls(seed, segment, cls._filled(order, cls._places(hashes, segment, size), cls._marks(hashes), size))
            seed += 1

    @staticmethod
    def _peeled(places: tuple, size: int) -> list[tuple[int, int]] | None:
        """(key, cell it is alone in) in the order of peeling; None if some keys never stand alone."""
        load, held = np.zeros(size, np.int64), np.zeros(size, np.int64)
        numbers = np.arange(len(places[0]))
        for cells in places:
            np.add.at(load, cells, 1)
            np.bitwise_xor.at(held, cells, numbers)
        alone = np.flatnonzero(load == 1).tolist()
        load, held, triples = load.tolist(), held.tolist(), list(zip(*(p.tolist() for p in places), strict=True))
        order = []
        while alone:
            cell = alone.pop()
            if load[cell] != 1:
                continue
            key = held[cell]
            order.append((key, cell))
            for other in triples[key]:
                load[other] -= 1
                held[other] ^= key
                if load[other] == 1:
                    alone.append(other)
        return order if len(order) == len(triples) else None

    @staticmethod
    def _filled(order: list[tuple[int, int]], places: tuple, marks: np.ndarray, size: int) -> np.ndarray:
        cells, triples = [0] * size, list(zip(*(p.tolist() for p in places), strict=True))
        marks = marks.tolist()
        for key, cell in reversed(order):
            a, b, c = triples[key]
            cells[cell] ^= marks[key] ^ cells[a] ^ cells[b] ^ cells[c]  # the cell itself is still 0
        return np.array(cells, np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be a member."""
        hashes = _mixed(keys.astype(np.uint64), self.seed)
        a, b, c = self._places(hashes, self.segment, len(self.cells))
        return (self.cells[a] ^ self.cells[b] ^ self.cells[c]) == self._marks(hashes)


@dataclass(frozen=True)
class Snapshot:
    """Digests first seen at one time, never changed: ``entries`` (digest, keep_id, n), and ``filters`` by bucket of digests."""

    entries: DataFrame
    filters: DataFrame
    buckets: int


def _key(digest: Column) -> Column:
    """The 64 bits of a digest that filters know."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("bigint")


def _bucket(digest: Column, buckets: int) -> Column:
    return F.pmod(_key(digest), F.lit(buckets)).alias("bucket")


def snapshot(entries: DataFrame) -> Snapshot:
    """A snapshot of staged ``entries``. Distinct digests spread evenly, so a bucket stays near BUCKET_KEYS whatever the number of copies."""
    buckets = 1 + entries.count() // BUCKET_KEYS

    def build(group: pa.Table) -> pa.Table:
        made = FuseFilter.of(group.column("key").to_numpy())
        return pa.table({"bucket": group.column("bucket")[:1], "seed": pa.array([made.seed]), "segment": pa.array([made.segment]), "cells": pa.array([made.cells.tobytes()])})

    keyed = entries.select(_bucket(F.col("digest"), buckets), _key(F.col("digest")).alias("key"))
    made = keyed.groupBy("bucket").applyInArrow(build, "bucket bigint, seed bigint, segment bigint, cells binary")
    return Snapshot(entries, stage(made, "filters"), buckets)


def screen(digests: DataFrame, known: Snapshot) -> DataFrame:
    """Those of the distinct ``digests`` that the filters of a snapshot let pass. Only digests and filters meet, no texts."""

    def passed(asked: pa.Table, filters: pa.Table) -> pa.Table:
        if not filters.num_rows or not asked.num_rows:
            return asked.select(["digest"]).slice(0, 0)
        f = filters.to_pylist()[0]
        hit = FuseFilter(f["seed"], f["segment"], np.frombuffer(f["cells"], np.uint8)).holds(asked.column("key").to_numpy())
        return asked.select(["digest"]).filter(pa.array(hit))

    asked = digests.select(_bucket(F.col("digest"), known.buckets), _key(F.col("digest")).alias("key"), "digest")
    return asked.groupBy("bucket").cogroup(known.filters.groupBy("bucket")).applyInArrow(passed, "digest binary")


def _rows_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``texts`` (digest, text) whose digest is ``wanted`` (distinct, staged). A list of proven size is broadcast, so no text
    moves; a longer one meets the rows by a shuffle, in which copies of one text are dealt by a salt."""
    if wanted.count() <= BROADCAST_DIGESTS:
        return texts.join(F.broadcast(wanted), "digest")
    salted = wanted.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    dealt = texts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return dealt.join(salted, ["digest", "salt"]).drop("salt")


def confused(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """The byte check: those of the ``repeated`` digests that different texts share, none with a sound digest. Equal texts combine before
    the shuffle, so a text with very many copies moves once a task."""
    distinct = _rows_of(texts, repeated).groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    return distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")


def dedupe(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, digest: Callable[[Column], Column] = F.unhex
) -> DataFrame:
    """(<id>, keep_id, group_size, kept, text_sha256) of every row: of the rows with one text, that of the largest id stays.

    The rows arrive in ``batches`` by a hash of their id, as a corpus grows. Of a batch, copies among its own rows are grouped first. Its
    distinct digests are screened by the filters of each earlier snapshot; what no filter lets pass is new and becomes the next snapshot,
    what passes is joined with the exact entries. Snapshots never change: what a later batch adds to a known text is kept as an addition of
    its own, and all are summed at the end. The bytes of all texts whose digest came more than once are compared.

    A null text is empty. A null id counts as less than any other. Of rows that repeat id and text one stays. An empty table gives no rows.
    ``digest`` makes a digest of a text's SHA-256 in hex; texts that share a digest are told apart by their bytes.
    """
    source = columns(docs, id_col, text_col).toDF("id", "raw").select("id", F.coalesce("raw", F.lit("")).alias("text"))
    sha = F.sha2("text", 256)
    arrival = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    # rows that repeat id and text combine here; texts stay behind
    members = source.select("id", sha.alias("sha"), arrival.alias("batch")).groupBy("id", "sha", "batch").agg(F.count(F.lit(1)).alias("m"))
    members = stage(members.withColumn("digest", digest(F.col("sha"))), "members")

    snapshots: list[Snapshot] = []
    additions: list[DataFrame] = []
    for number in range(batches):
        fresh = members.where(F.col("batch") == number).groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("m").alias("n"))
        fresh = stage(fresh, "batch")
        for known in snapshots:
            passed = stage(screen(fresh, known), "passed")
            exact = known.entries.join(passed, "digest", "left_semi").select("digest")  # without the filter's false positives
            found = stage(fresh.join(exact, "digest", "left_semi"), "found")
            additions.append(found)
            fresh = fresh.join(found.select("digest"), "digest", "left_anti")
        snapshots.append(snapshot(stage(fresh, "entries")))

    entries, added = reduce(DataFrame.unionAll, [s.entries for s in snapshots]), additions
    again = reduce(DataFrame.unionAll, [a.select("digest") for a in added], entries.where("n > 1").select("digest"))
    texts = source.select("id", "text", sha.alias("sha")).withColumn("digest", digest(F.col("sha")))
    mixed = stage(confused(texts.select("digest", "text"), stage(again.distinct(), "again")), "mixed")
    classes = reduce(DataFrame.unionAll, added, entries).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    # written first, so that both sides of the join are plain exchanges, of which a partition with a hot digest can be split
    classes = stage(classes.join(mixed, "digest", "left_anti"), "classes")
    rows = members.join(classes, "digest").select("id", "keep_id", "group_size", "m", "sha")
    if not mixed.isEmpty():
        told = texts.join(mixed, "digest", "left_semi").groupBy("id", "text", "sha").agg(F.count(F.lit(1)).alias("m"))
        told = stage(told, "told")
        by_bytes = stage(told.groupBy("text").agg(F.max("id").alias("keep_id"), F.sum("m").alias("group_size")), "by-bytes")
        rows = rows.unionByName(told.join(by_bytes, "text").select("id", "keep_id", "group_size", "m", "sha"))
    each = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("copy"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
