"""Byte-pair encoding with a queue of merge ranks over a linked list of symbols, and decoding by concatenation."""

from __future__ import annotations

import hashlib
import json
from array import array
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import columns, map_batches, per_worker

#: fixed value: the pattern by which byte-level vocabularies split a text
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

CACHE_WORDS, CACHE_CHARS = 500_000, 48


def byte_letters() -> list[str]:
    """The character that stands for each byte in a vocabulary: itself where printable, else the next one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, vocabulary: str, cache_words: int = CACHE_WORDS):
        import regex

        data = json.loads(vocabulary)
        ids: dict[str, int] = data["model"]["vocab"]
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        self.first = [ids[c] for c in letters]
        self.pairs: list[tuple[int, int, int]] = []
        self.ranks: dict[int, int] = {}
        for pair in data["model"]["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = ids[left], ids[right]
            self.ranks.setdefault(a << 32 | b, len(self.pairs))
            self.pairs.append((a, b, ids[left + right]))
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for word, i in ids.items():
            self.strings[i] = bytes(to_byte[c] for c in word)
        for word, i in self.special.items():
            self.strings[i] = word.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.words = regex.compile(SPLIT)
        self.chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.cache_words = cache_words

    def merge(self, symbols: list[int]) -> list[int]:
        """Join the pair of lowest rank, leftmost first, until no pair of the list has a rank.

        The queue holds rank and position. An entry is stale, and skipped, when the pair at its position is no longer the pair of that rank.
        """
        n, rank_of, pairs = len(symbols), self.ranks.get, self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        left = symbols[0] if n else 0
        for i in range(1, n):
            right = symbols[i]
            rank = rank_of(left << 32 | right)
            if rank is not None:
                queue.append(rank << 32 | i - 1)
            left = right
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            left, right, joined = pairs[entry >> 32]
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            k = after[i] = after[j]
            symbols[i], symbols[j] = joined, -1
            if k < n:
                before[k] = i
                rank = rank_of(joined << 32 | symbols[k])
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] << 32 | joined)
                if rank is not None:
                    heappush(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        found = self.known.get(word)
        if found is None:
            found = array("I", self.merge([self.first[b] for b in word.encode()])).tobytes()
            if len(word) <= CACHE_CHARS:
                if len(self.known) >= self.cache_words:
                    self.known.clear()
                self.known[word] = found
        return found

    def _chunk(self, text: str) -> bytes:
        return b"".join([self._word(w) for w in self.words.findall(text)])

    def _blank_chunk(self, part: str) -> bytes:
        """Ids of a blank and ``part``; letters, at most with one of the commonest stops after them, need no pattern."""
        if part.isalpha():
            return self._word(" " + part)
        if part[-1] in ".," and part[:-1].isalpha():
            return self._word(" " + part[:-1]) + self._word(part[-1])
        return self._chunk(" " + part)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A text may be cut before a blank that follows and precedes other than white space: no word crosses such a place. What lies
        between two cuts mostly repeats, so its ids are looked up.
        """
        parts = text.split(" ")
        known = self.chunks
        found = list(map(known.get, parts))
        found[0] = self._chunk(parts[0]) if len(parts) == 1 or (parts[0] and not parts[0][-1].isspace()) else None
        if None not in found:
            return b"".join(found)
        out: list[bytes] = []
        i, n = 0, len(parts)
        while i < n:
            ids = found[i]
            if ids is not None and (i == 0 or (parts[i - 1] and not parts[i - 1][-1].isspace())):
                out.append(ids)
                i += 1
                continue
            j = i + 1
            while j < n and not (parts[j - 1] and not parts[j - 1][-1].isspace() and parts[j] and not parts[j][0].isspace()):
                j += 1
            part = parts[i]
            if i and j == i + 1 and part and not part[0].isspace() and not part[-1].isspace():
                ids = self._blank_chunk(part)
                if len(part) <= CACHE_CHARS:
                    if len(known) >= self.cache_words:
                        known.clear()
                    known[part] = ids
            else:
                ids = self._chunk((" " if i else "") + " ".join(parts[i:j]))
            out.append(ids)
            i = j
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as native unsigned 32-bit integers; the strings of special tokens become their ids."""
        if self.marks is None or not any(s in text for s in self.special):
            return self._plain(text) if text else b""
        out = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            elif part:
                out.append(self._plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The text of a vocabulary file, from a local path of the driver or any path Spark reads; a few MB."""
    import os

    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            return f.read()
    return spark.read.text(path, wholetext=True).head()[0]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", output: str = "digests") -> DataFrame:
    """Encode every whole text and decode the ids again.

    ``output="ids"`` returns (id, ids array<int>, decoded string); ``"digests"`` returns (id, n_tokens, ids_sha256, decoded_sha256), the
    hashes of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8.

    One row per input row: a null text is encoded as the empty text (no ids); a null or repeated id is returned as it is; an
    empty table gives no rows. Texts are never cut; each word is merged in n log n. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(docs.sparkSession, vocabulary))
    digests = output == "digests"
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ("n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")

    def run(batches):
        codec = per_worker(("bpe", vocabulary), lambda: Codec(shared.value))
        for batch in batches:
            rows: list[list] = [[] for _ in range(3 if digests else 2)]
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                decoded = codec.decode(ids)
                if digests:
                    little = ids if array("I", [1]).tobytes()[0] else array("I", ids).byteswap()
                    made = len(ids) // 4, hashlib.sha256(little).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
                else:
                    made = array("I", ids).tolist(), decoded
                for column, value in zip(rows, made, strict=True):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.string()] if digests else [pa.list_(pa.int32()), pa.string()]
            names = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows, types)], names)

    return map_batches(columns(docs, id_col, text_col), run, schema)
