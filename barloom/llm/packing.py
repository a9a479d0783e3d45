"""Packing of token sequences: a configuration linear program over the length histogram, by multiplicative weights and knapsack pricing."""

from __future__ import annotations

import math
import os
import zlib
from array import array
from dataclasses import dataclass
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.bpe import read_vocabulary
from barloom.llm.common import columns, map_batches, per_worker, stage

CAPACITY, END_ID = 2048, 0
CACHE_WORDS, CACHE_BYTES = 700_000, 48
#: Most pricing rounds of the linear program, how strongly a covered length's price falls, and how near to the best a content must be
#: to be taken, also how near bound and solution must come.
ROUNDS, RATE, CLOSE = 240, 0.5, 0.005
#: Share of bins over the program's bound at which no further ways are tried.
GAP = 0.0005
#: Rows of one length that one task numbers.
NUMBERED = 1000

#: Bins of one kind: how many, and the (length, copies) that each holds.
Bins = tuple[int, list[tuple[int, int]]]


class WordCodec:
    """A tokenizer whose words never cross white space, with the ids of frequent words kept."""

    def __init__(self, vocabulary: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ids = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(1 + max(ids.values()), bool)
        self.ends[[i for word, i in ids.items() if word.endswith("</w>")]] = True
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.cache_words = cache_words

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _letters(self, words: list[str]) -> None:
        """Put words of letters alone, each a single word of the vocabulary's pattern, among the known words."""
        ids = np.frombuffer(self._ids(" ".join(words)), dtype=np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            self.words.update((w, self._ids(w)) for w in words)
            return
        flat, begin = ids.tobytes(), 0
        for word, end in zip(words, (4 * ends).tolist(), strict=True):
            self.words[word] = flat[begin:end]
            begin = end

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Ids of new chunks. Letters, at most with one of the commonest stops after them, are looked up as lower-case words."""
        out, plain = {}, []
        for chunk in chunks:
            text = chunk.decode()
            stop = text[-1] if text[-1] in ".," else ""
            word = text[:-1] if stop else text
            word = (word if word.isascii() else normalize("NFC", word)).replace("Σ", "σ").lower()
            if word.isalpha():
                plain.append((chunk, word, stop))
            else:
                out[chunk] = self._ids(text)
        if len(self.words) > self.cache_words:
            self.words.clear()
        new = [w for w in {w for _, w, _ in plain} if w not in self.words]
        if new:
            self._letters(new)
        for stop in {s for _, _, s in plain if s and s not in self.words}:
            self.words[stop] = self._ids(stop)
        for chunk, word, stop in plain:
            out[chunk] = self.words[word] + self.words[stop] if stop else self.words[word]
        return out

    def encode(self, text: str) -> bytes:
        """Ids as native unsigned 32-bit integers. The text is cut at ASCII white space, which ends words and is no part of them."""
        parts = text.encode().split()
        known = self.chunks
        found = list(map(known.get, parts))
        if None in found:
            fresh = self._learn({p for p, ids in zip(parts, found, strict=True) if ids is None})
            found = [fresh[p] if ids is None else ids for p, ids in zip(parts, found, strict=True)]
            if len(known) + len(fresh) > self.cache_words:
                known.clear()
            known.update((p, ids) for p, ids in fresh.items() if len(p) <= CACHE_BYTES)
        return b"".join(found)


def pieces(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids followed by the id that ends it, cut where over ``capacity``."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(docs.sparkSession, vocabulary))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    end = array("I", [END_ID]).tobytes()

    def run(batches):
        codec = per_worker(("words", vocabulary), lambda: WordCodec(shared.value))
        for batch in batches:
            owner, rows, ids_of = [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.frombuffer(codec.encode(text.as_py() or "") + end, dtype=np.uint32).astype("<u4", copy=False)
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    owner.append(i)
                    rows.append((piece, start, len(part), zlib.crc32(part.tobytes())))
                    if keep_ids:
                        ids_of.append(part.astype(np.int32))
            made = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                made, names = [*made, pa.array(ids_of, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *made], names)

    return map_batches(columns(docs, id_col, text_col), run, schema)


def price(lengths: list[int], values: list[float], most: list[int], capacity: int) -> dict[int, int]:
    """The content of greatest value that fits, with at most ``most`` copies of each length: a knapsack by dynamic programming.

    Copies are offered in packets of 1, 2, 4, ..., so that a length costs the logarithm of its copies.
    """
    best = np.zeros(capacity + 1)
    packets = []
    for length, value, left in zip(lengths, values, most, strict=True):
        left, copies = min(left, capacity // length), 1
        while left > 0:
            copies = min(copies, left)
            size = copies * length
            offered = best[:-size] + copies * value
            better = offered > best[size:] + 1e-12
            np.copyto(best[size:], offered, where=better)
            packets.append((length, copies, better))
            left, copies = left - copies, 2 * copies
    room, chosen = int(best.argmax()), {}
    for length, copies, better in reversed(packets):
        if room >= copies * length and better[room - copies * length]:
            chosen[length] = chosen.get(length, 0) + copies
            room -= copies * length
    return chosen


def best_fit(left: dict[int, int], capacity: int) -> list[Bins]:
    """Best-fit decreasing over a histogram; bins of equal content are one entry, so its work does not grow with the counts."""
    open_: list[list[Bins]] = [[] for _ in range(capacity + 1)]
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            room = next((r for r in range(length, capacity + 1) if open_[r]), capacity)
            each = room // length
            if open_[room]:
                many, content = open_[room].pop()
            else:
                many, content = math.ceil(n / each), []
            full = min(many, n // each)
            part = min(n - full * each, each) if full < many else 0
            if full:
                open_[room - each * length].append((full, [*content, (length, each)]))
            if part:
                open_[room - part * length].append((1, [*content, (length, part)]))
            if many > full + bool(part) and content:
                open_[room].append((many - full - bool(part), content))
            n -= full * each + part
    return [bins for kinds in open_ for bins in kinds]


def fill(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to ``capacity`` the greatest value that fits, any number of copies, and the item taken last there.

    One pass prices the contents around all lengths: the best with item i has its value and the best of the room it leaves. An item of
    -1 means that the room one smaller is worth the same.
    """
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fitting[room]:
            offered = values[: fitting[room]] + best[room - lengths[: fitting[room]]]
            item = int(offered.argmax())
            if offered[item] > best[room] + 1e-12:
                best[room], last[room] = offered[item], item
    return best, last


@dataclass
class Program:
    """The fractional configuration program: contents with weights that cover every length, prices, and the bound that they prove."""

    weights: dict[tuple[tuple[int, int], ...], float]
    prices: dict[int, float]
    bound: float
    rounds: int

    @property
    def size(self) -> float:
        return sum(self.weights.values())

    @property
    def least(self) -> int:
        """No packing has fewer bins."""
        return math.ceil(self.bound - 1e-6)


def program(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, rate: float = RATE, close: float = CLOSE) -> Program:
    """Least total weight of contents that cover each length as often as it occurs, by multiplicative weights.

    A row for each length, a column for each content of a bin. A length's price starts at its share of a bin, an optimal dual where bins
    can be filled, and falls by exp(-step) when its coverage grows by its count, step being rate over the root of the round. Each round a knapsack prices, for every length, the
    best content around it. Those within ``close`` of the best of all are taken in order of value, each with as much weight as
    leaves no length's coverage grown by more than its count in the round. So a round's size is set by no single rare length, and
    prices go stale by a factor of exp(step) at most. The rounds' weights times their steps, over the least coverage, are a solution;
    the worth of all lengths at a round's prices over its best content is a bound, of which the greatest is kept. Ends when the two
    meet within ``close``, or in whole bins.
    """
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0), np.int64)
    counts = np.array([histogram[k] for k in lengths.tolist()], float)
    if not len(lengths):
        return Program({}, {}, 0.0, 0)
    sizes = lengths.tolist()
    covered, taken = np.zeros(len(lengths)), {}
    bound, prices, smallest = 0.0, lengths / capacity, None
    done = 0
    for done in range(1, rounds + 1):
        values = lengths / capacity * np.exp(covered.min() - covered)
        step = rate / math.sqrt(done)
        best, last = fill(lengths, values, capacity)
        worth = float(values @ counts) / best[capacity]
        if worth > bound:
            bound, prices = worth, values / best[capacity]
        around = values + best[capacity - lengths]
        free = counts.tolist()
        for item in np.lexsort((covered, -np.round(around / best[capacity] / close))).tolist():
            if around[item] < (1 - close) * best[capacity] and done % 4:
                break
            if free[item] <= 0:
                continue
            content, room = {item: 1}, capacity - sizes[item]
            while room > 0:
                other = int(last[room])
                if other < 0:
                    room -= 1
                else:
                    content[other] = content.get(other, 0) + 1
                    room -= sizes[other]
            weight = min(free[i] / min(n, counts[i]) for i, n in content.items())
            if weight <= 0 and covered[item] > 0:
                continue
            if weight <= 0:  # not in any content so far, and its company is used up in this round
                content, weight = {item: 1}, free[item]
            for i, n in content.items():
                free[i] -= weight * min(n, counts[i])
            key = tuple(sorted(((sizes[i], int(min(n, counts[i]))) for i, n in content.items()), reverse=True))
            taken[key] = taken.get(key, 0.0) + step * weight
        covered += step * (1 - np.array(free) / counts)
        least = covered.min()
        if least > 0:
            size = sum(taken.values()) / least
            if smallest is None or size < smallest[0]:
                smallest = (size, {key: weight / least for key, weight in taken.items()})
            if size <= max(bound * (1 + close), math.ceil(bound - 1e-6)):
                break
    weights = smallest[1] if smallest else {((k, 1),): float(histogram[k]) for k in sizes}
    return Program(weights, dict(zip(sizes, prices.tolist(), strict=True)), bound, done)


def rounded(weights: dict[tuple[tuple[int, int], ...], float], left: dict[int, int]) -> list[Bins]:
    """Whole bins of the contents, taken out of ``left``: running sums of weights are rounded down, so the total is kept."""
    bins, total, given = [], 0.0, 0
    for content, weight in sorted(weights.items(), reverse=True):
        total += weight
        many = min(int(total + 1e-9) - given, *(left.get(length, 0) // n for length, n in content))
        if many > 0:
            bins.append((many, list(content)))
            given += many
            for length, n in content:
                left[length] -= many * n
    return bins


def dive(left: dict[int, int], prices: dict[int, float], capacity: int, rounds: int, lag: float) -> list[Bins]:
    """Whole bins of the content of greatest price among what is left, taken out of ``left``, half of what it allows at a time.

    A price is multiplied by exp(lag * the length's share not yet taken beyond that of all lengths).
    """
    begun, bins = {k: n for k, n in left.items() if n > 0}, []
    worth = sum(prices[k] * n for k, n in begun.items())
    for _ in range(rounds):
        lengths = sorted((k for k, n in left.items() if n > 0), reverse=True)
        if not lengths:
            break
        share = 1 - sum(prices[k] * left[k] for k in lengths) / worth if worth else 0.0
        values = [prices[k] * math.exp(lag * (share - 1 + left[k] / begun[k])) for k in lengths]
        content = price(lengths, values, [left[k] for k in lengths], capacity)
        if not content:
            break
        many = max(1, min(left[k] // n for k, n in content.items()) // 2)
        bins.append((many, sorted(content.items(), reverse=True)))
        for k, n in content.items():
            left[k] -= many * n
    return bins


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, rate: float = RATE) -> list[Bins]:
    """Bins that hold every length of the histogram exactly as often as it occurs, as few as are found.

    The fractional program is rounded, and what the rounding leaves is packed by best-fit decreasing. Where that takes more bins than the
    program's bound by over ``GAP`` of it, more ways to round are tried and the first of the fewest bins counts: whole bins of greatest price for what the
    rounding leaves, the same for all lengths, with and without a higher price for lengths that lag behind, and best-fit for all lengths.
    A twentieth of the rounds is tried first, which is enough where bins can be filled.
    """
    whole = {length: n for length, n in histogram.items() if n > 0}

    def packed(solved: Program, fractional: bool, dives: int, lag: float = 0.0) -> list[Bins]:
        left = dict(whole)
        bins = rounded(solved.weights, left) if fractional else []
        bins += dive(left, solved.prices, capacity, dives, lag)
        return bins + best_fit({length: n for length, n in left.items() if n > 0}, capacity)

    fewest: tuple[int, list[Bins]] | None = None
    for effort in (math.ceil(rounds / 20), rounds):
        solved = program(whole, capacity, effort, rate)
        for way in ((True, 0), (False, 0), (True, effort), (False, effort, rate), (False, effort)):
            bins = packed(solved, *way)
            size = sum(many for many, _ in bins)
            if fewest is None or size < fewest[0]:
                fewest = (size, bins)
            if size <= solved.least * (1 + GAP):
                return bins
    return fewest[1]


def _places(bins: list[Bins]) -> dict[int, np.ndarray]:
    """For each length its runs of ranks: first rank, copies in a bin, first bin, offset in the bin."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for many, content in bins:
        offset = 0
        for length, copies in content:
            rank = ranks.get(length, 0)
            runs.setdefault(length, []).append((rank, copies, first, offset))
            ranks[length] = rank + many * copies
            offset += copies * length
        first += many
    return {length: np.array(r, dtype=np.int64) for length, r in runs.items()}


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    keep_ids: bool = False,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every document's tokens in as few sequences of at most ``capacity`` as the program finds.

    Returns (id, piece, start, length, ids_crc32, sequence_id, offset) for each piece, with ``keep_ids`` also its ids. Only documents
    longer than a sequence are cut. Pieces lie in their sequence without gaps, from 0.

    A null text counts as empty: one piece with the closing id alone. Null and repeated ids are kept as they are, each row with its own
    pieces. An empty table gives no rows. The driver sees the histogram of lengths, at most ``capacity`` numbers, and nothing else.
    Pieces are numbered within their length in small buckets, so a length that very many share is not gathered in one task.
    """
    cut = stage(pieces(docs, vocabulary, id_col, text_col, capacity, keep_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(solve(histogram, capacity, rounds))
    spark = docs.sparkSession
    # one row for each length, at most ``capacity`` of them
    dealt = spark.createDataFrame([(k, 1 + n // NUMBERED) for k, n in histogram.items()] or [(0, 1)], "length bigint, buckets bigint")
    mixed = cut.join(F.broadcast(dealt), "length").withColumn("bucket", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), "buckets"))
    counts = mixed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = stage(counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begins")), "begins")
    within = Window.partitionBy("length", "bucket").orderBy(id_col, "piece", "ids_crc32")
    ranked = mixed.withColumn("rank", F.row_number().over(within) - 1).join(begins, ["length", "bucket"])
    names = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ready = ranked.select(*names, (F.col("begins") + F.col("rank")).alias("rank"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields] + ["sequence_id bigint", "offset bigint"])

    def run(batches):
        for batch in batches:
            lengths = batch.column(names.index("length")).to_numpy()
            rank = batch.column(len(names)).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                runs = places[length]
                found = runs[np.searchsorted(runs[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - found[:, 0]
                sequence[at] = found[:, 2] + inside // found[:, 1]
                offset[at] = found[:, 3] + inside % found[:, 1] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return map_batches(ready, run, schema)
