"""License scans by an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import columns, map_batches, stage

#: fixed values: the base phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: fixed values: sentences by which licenses are given
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "licensed under a Creative Commons Attribution-ShareAlike International License",
    "gpl": "This work is licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "All rights reserved",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
#: Share of a template's words that a block must hold in their order; templates of fewer than WHOLE words must be whole.
CONTAINMENT, WHOLE = 0.8, 10

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased, in UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def places(found: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the words of a phrase stand one after the other."""
    text, part = b" " + b" ".join(found) + b" ", b" " + b" ".join(phrase) + b" "
    out, at, seen, word = [], text.find(part), 0, 0
    while at >= 0:
        word, seen = word + text.count(b" ", seen, at), at
        out.append(word)
        at = text.find(part, at + 1)
    return out


class Template(NamedTuple):
    """``order``: the words as numbers, of which ``kept`` must stand in this order within ``span`` words. ``tokens``: the different ones, the rarest
    first; ``need`` of them are then in the block."""

    label: str
    tokens: list[int]
    need: int
    order: list[int]
    kept: int
    span: int

    @property
    def prefix(self) -> list[int]:
        """A block with ``need`` of the tokens has one of these."""
        return self.tokens[: len(self.tokens) - self.need + 1]


def frequencies(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each token of the templates occurs."""

    def run(batches):
        count = Counter()
        for batch in batches:
            for text in batch.column(0):
                count.update(vocabulary.intersection(words(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], ["token", "n"])

    counted = map_batches(columns(docs, text_col), run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return {bytes(r["token"]): r["n"] for r in counted.collect()}


def ordered(templates: dict[str, str], count: dict[bytes, int], containment: float) -> tuple[dict[bytes, int], list[Template]]:
    """(the number of each token by global frequency, the templates in these numbers)."""
    lists = {label: words(text) for label, text in templates.items()}
    every = sorted({w for own in lists.values() for w in own}, key=lambda t: (count.get(t, 0), t))
    number = {t: i for i, t in enumerate(every)}
    out = []
    for label, own in lists.items():
        if own:
            kept = len(own) if len(own) < WHOLE else math.ceil(containment * len(own) - 1e-9)
            tokens = sorted({number[t] for t in own})
            out.append(Template(label, tokens, max(1, len(tokens) - (len(own) - kept)), [number[t] for t in own], kept, len(own) + len(own) // 4))
    return number, out


def blocks_of(found: list[bytes], number: dict[bytes, int], rare: frozenset[bytes], length: int) -> list[list[int]]:
    """The words of each block that has a prefix token, as numbers in their order, -1 for words of no template. Blocks are 2 x ``length`` words and begin every
    ``length`` words, so every run of ``length`` words lies within one."""
    starts = set()
    for i, word in enumerate(found):
        if word in rare:
            starts.add(i // length * length)
            starts.add(max(0, i // length - 1) * length)
    return [[number.get(w, -1) for w in found[s : s + 2 * length]] for s in sorted(starts)]


def in_order(block: list[int], order: list[int], kept: int, span: int) -> int:
    """The most words of a template that stand in its order within ``span`` words of a block; 0 if fewer than ``kept``."""
    best, heads = 0, set(order[: len(order) - kept + 1])
    for at, token in enumerate(block):
        if token in heads:
            row = [0] * (len(order) + 1)
            for word in block[at : at + span]:
                if word >= 0:
                    before = 0
                    for k, wanted in enumerate(order, 1):
                        before, row[k] = row[k], max(row[k], row[k - 1], before + 1 if word == wanted else 0)
            best = max(best, row[-1])
            if best == len(order):
                break
    return best if best >= kept else 0


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Base labels come from phrases that stand word for word. A template's label is added where a stretch of the text, a quarter longer than the template at most, has at
    least the ``containment`` share of its words in their order; all of them where it has fewer than WHOLE words, so that no label comes from
    common words alone. Blocks and templates meet on prefix tokens of the global frequency order, pairs that are too short or whose positions
    leave too few tokens are dropped, then those whose intersection is too small, and the rest is held against the order. ``score`` is the greatest share among the
    templates found, 1 where a base phrase stands, else 0.

    A null text counts as empty: no words, empty labels, null places. Repeated rows and null ids each return their row. An empty
    table gives no rows. Whole texts are read; other columns are not.
    """
    templates = TEMPLATES if templates is None else templates
    tokens = {w for t in templates.values() for w in words(t)}
    number, sets = ordered(templates, frequencies(docs, text_col, tokens), containment)
    at_rank = {i: t for t, i in number.items()}
    rare = frozenset(at_rank[i] for t in sets for i in t.prefix)
    length = max([t.span for t in sets], default=1)
    phrases = [(p.encode(), p.encode().split(), label) for p, label in PHRASES.items()]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, row bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, blocks array<array<int>>"

    def run(batches):
        row = (TaskContext.get().partitionId() << 33) - 1
        for batch in batches:
            out = []
            for text in batch.column(1):
                row += 1
                found = words(text.as_py())
                at, labels = [], []
                for _, phrase, label in phrases:
                    own = places(found, phrase) if phrase[0] in found else []
                    at += own
                    labels += [label] * bool(own)
                out.append((row, len(found), len(at), min(at, default=None), max(at, default=None), sorted(labels), blocks_of(found, number, rare, length)))
            types = [pa.int64()] * 5 + [pa.list_(pa.string()), pa.list_(pa.list_(pa.int32()))]
            made = [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], [id_col, "row", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])

    counted = stage(map_batches(columns(docs, id_col, text_col), run, schema), "blocks")
    spark = docs.sparkSession
    # as many rows as the templates have prefix tokens
    index = spark.createDataFrame(
        [(token, at, n, t.tokens, t.need) for n, t in enumerate(sets) for at, token in enumerate(t.prefix)], "token int, at int, template int, wanted array<int>, need int"
    )
    blocks = counted.where("size(blocks) > 0").select("row", F.explode("blocks").alias("block"))
    blocks = blocks.withColumn("held", F.expr("array_sort(array_distinct(filter(block, x -> x >= 0)))"))
    probes = blocks.select("row", "block", "held", F.posexplode("held").alias("place", "token"))
    rest = "least(place, at) + 1 + least(size(held) - place, size(wanted) - at) - 1"
    met = probes.join(F.broadcast(index), "token").where(f"size(held) >= need and {rest} >= need")
    pairs = met.where("size(array_intersect(held, wanted)) >= need").select("row", "template", "block")

    def verify(batches):
        known: dict[tuple, int] = {}
        for batch in batches:
            rows, labels, shares = [], [], []
            for row, n, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = n, *block
                if key not in known:
                    if len(known) >= 4096:
                        known.clear()
                    known[key] = in_order(block, sets[n].order, sets[n].kept, sets[n].span)
                if known[key]:
                    rows.append(row)
                    labels.append(sets[n].label)
                    shares.append(known[key] / len(sets[n].order))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(labels, pa.string()), pa.array(shares, pa.float64())], ["row", "label", "share"])

    agreed = map_batches(pairs, verify, "row bigint, label string, share double")
    labelled = agreed.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    joined = counted.drop("blocks").join(stage(labelled, "labels"), "row", "left")
    both = F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        id_col,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
