"""Language identification by partial matching: byte context trees with escape probabilities, learned per language and then frozen."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import columns, map_batches, per_worker

ORDER, CHUNK = 3, 1 << 16
#: Rows per language, on average, that the trees are learned from.
SAMPLE_ROWS = 500
#: Most code lengths (contexts x bytes x languages) that are tabulated ahead for an order of the trees, the most frequent contexts first. The
#: others are put together from the counts when they come: slower, with the same result.
MAX_CELLS = 4_000_000
#: A text of a language may have as many bits a byte as the median of its learned rows plus WIDE times the distance from there to their upper
#: quartile, at least LEAST_BITS, and SPARE_BITS in all, about ten bytes that the language does not have, so that no text is told by one odd word.
WIDE, LEAST_BITS, SPARE_BITS = 4, 2.0, 128
#: Buckets a bit in the sketches of code lengths, and bytes for which such a length keeps to one language.
STEPS, WINDOW = 50, 64
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """The lower-case letters of a text in UTF-8, with one blank for each run of anything else."""
    return _OTHER.sub(" ", (text or "").lower()).encode()


def grams(text: bytes) -> np.ndarray:
    """For every byte the four bytes that end there, as one number; before the text lie blanks."""
    b = np.frombuffer(b"   " + text, dtype=np.uint8).astype(np.int64)
    return (b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]) if len(text) else np.zeros(0, np.int64)


def is_held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(id_column.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def half_of(text: Column) -> Column:
    """0 or 1 by the text, so that copies lie in the same half."""
    return F.pmod(F.xxhash64(text, F.lit(13)), F.lit(2))


def _learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = columns(docs, id_col, text_col, lang_col).toDF("id", "text", "lang")
    rows = rows.where("lang is not null and text is not null and id is not null").where(~is_held_out(F.col("id")))
    return rows.withColumn("half", half_of(F.col("text")))


Counts = list[tuple[str, int, int]]


def count(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int) -> tuple[Counts, Counts]:
    """(language, gram, occurrences) over a sample of the labelled rows that are not held out, for each half of the texts.

    Rows are taken by a hash of the id, each language at the rate that gives ``sample_rows`` rows on average, whole texts each.
    """
    rows = _learnable(docs, id_col, text_col, lang_col)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [], []
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, sample_rows / n)])[F.col("lang")]
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < rate * (1 << 20)).select("half", "lang", "text")

    def run(batches):
        for batch in batches:
            by_lang: dict[tuple[int, str], list[np.ndarray]] = {}
            for half, lang, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                by_lang.setdefault((half, lang), []).append(grams(letters(text)))
            for (half, lang), parts in by_lang.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([half] * len(found)), pa.array([lang] * len(found)), pa.array(found), pa.array(n)], ["half", "lang", "gram", "n"])

    counted = map_batches(sample, run, "half bigint, lang string, gram bigint, n bigint").groupBy("half", "lang", "gram").agg(F.sum("n").alias("n"))
    halves: tuple[Counts, Counts] = ([], [])
    for half, *one in counted.collect():
        halves[half].append(tuple(one))
    return halves


class Rows:
    """A sparse table: for each code in it the languages it has an entry for, and the entries."""

    def __init__(self, codes: np.ndarray, langs: np.ndarray, values: np.ndarray):
        """Codes ascend; a code comes once for each of its languages."""
        self.codes, begins = np.unique(codes, return_index=True)
        self.begins = np.append(begins, len(codes))
        self.langs, self.values = langs, values

    def add(self, codes: np.ndarray, out: np.ndarray) -> None:
        """Add the entries of ``codes[i]`` to row i of ``out``."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        row = np.flatnonzero(self.codes[at] == codes)
        begin, many = self.begins[at[row]], self.begins[at[row] + 1] - self.begins[at[row]]
        entry = np.repeat(begin - np.append(0, many.cumsum()[:-1]), many) + np.arange(many.sum())
        out[np.repeat(row, many), self.langs[entry]] += self.values[entry]


class Trees:
    """Frozen code lengths. A context is the longest known suffix of the bytes before, up to three.

    In a context seen T times with D different next bytes, a byte seen c times has probability c / (T + D); any other byte costs the
    escape D / (T + D) and is then coded in the next shorter context, at last as one of 256 equal bytes. So the length of every byte
    depends on its gram alone: it is 8 bits and, for every order, an entry of its context, the escape, and one of its gram, which takes the
    escape and the shorter lengths back where the language has the gram. Both tables hold what was seen and nothing else, so they grow with
    the sample and not with the languages times the bytes. The lengths of frequent contexts are also tabulated for all languages at once, as
    far as ``max_cells`` goes: ``bits[context, byte]`` is a row of one length per language. The others are summed up when they come.
    """

    def __init__(self, counts: list[tuple[str, int, int]], max_cells: int = MAX_CELLS):
        self.langs = sorted({lang for lang, _, _ in counts})
        if not self.langs:
            return
        n_lang = len(self.langs)
        at = {lang: i for i, lang in enumerate(self.langs)}
        lang = np.array([at[c[0]] for c in counts], np.int64)
        gram = np.array([c[1] for c in counts], np.int64)
        n = np.array([c[2] for c in counts], np.float64)
        seen = np.unique(gram & 255)
        self.size = len(seen) + 1  # class 0: bytes that no language has
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, self.size)
        size = self.size
        quad = [self.symbol[gram >> shift & 255] for shift in (24, 16, 8, 0)]
        self.escapes: list[Rows] = []
        self.grams: list[Rows] = []
        ids, bits = np.zeros(1, np.int32), np.full((1, size, n_lang), 8.0, np.float32)  # one of 256 equal bytes
        shorter_key, shorter_coded = np.zeros(0, np.int64), np.zeros(0)
        for order in range(ORDER + 1):
            code = np.zeros(len(gram), np.int64)
            for k in range(3 - order, 4):
                code = code * size + quad[k]
            key, where = np.unique(code * n_lang + lang, return_inverse=True)
            count_, own = np.bincount(where, n, len(key)), key % n_lang
            context, where = np.unique(key // n_lang // size * n_lang + own, return_inverse=True)
            total, distinct = np.bincount(where, count_, len(context)), np.bincount(where, minlength=len(context))
            escape = np.log2(total + distinct) - np.log2(distinct)
            coded = (np.log2(total + distinct))[where] - np.log2(count_)
            # a gram that was seen has a suffix that was seen
            suffix = key // n_lang % size**order * n_lang + own
            before = shorter_coded[np.searchsorted(shorter_key, suffix)] if order else 8.0
            self.escapes.append(Rows(context // n_lang, context % n_lang, escape))
            self.grams.append(Rows(key // n_lang, own, coded - escape[where] - before))
            shorter_key, shorter_coded = key, coded
            # tabulated: the most frequent contexts, where the shorter one is tabulated too
            known, where = np.unique(context // n_lang, return_inverse=True)
            row = ids[known % size ** (order - 1)] if order else np.zeros(1, np.int32)
            weight = np.where(row >= 0, np.bincount(where, total, len(known)), 0)
            kept = np.sort(np.argsort(-weight, kind="stable")[: max(max_cells // (size * n_lang), int(order == 0))])
            kept = kept[row[kept] >= 0]
            tabled = bits[row[kept]].astype(np.float64)
            spread = np.repeat(known[kept], size) * size + np.tile(np.arange(size), len(kept))
            flat = tabled.reshape(-1, n_lang)
            self.escapes[order].add(spread // size, flat)
            self.grams[order].add(spread, flat)
            if order == 0:
                ids, bits = np.zeros(1, np.int32), tabled.astype(np.float32)
            else:
                longer = ids[np.arange(size**order) % size ** (order - 1)]
                longer[known] = -1
                longer[known[kept]] = len(bits) + np.arange(len(kept))
                ids, bits = longer, np.concatenate([bits, tabled.astype(np.float32)])
        self.ids = ids
        self.bits = bits.reshape(-1, n_lang)

    def _rows(self, s: np.ndarray) -> np.ndarray:
        """The code lengths, one row per byte, of symbols after the first three."""
        size = self.size
        code = (s[:-3] * size + s[1:-2]) * size + s[2:-1]
        context = self.ids[code].astype(np.int64)
        found = self.bits[np.maximum(context, 0) * size + s[3:]]
        rest = np.flatnonzero(context < 0)
        if len(rest):
            gram = code[rest] * size + s[3:][rest]
            exact = np.full((len(rest), len(self.langs)), 8.0)
            for order in range(ORDER + 1):
                longest = gram % size ** (order + 1)
                self.escapes[order].add(longest // size, exact)
                self.grams[order].add(longest, exact)
            found[rest] = exact
        return found

    def lengths(self, text: bytes) -> np.ndarray:
        """The code length of a text in every language, in bits."""
        total = np.zeros(len(self.langs))
        padded = self.symbol[np.frombuffer(b"   " + text, dtype=np.uint8)]
        for begin in range(0, len(text), CHUNK):
            total += self._rows(padded[begin : begin + CHUNK + 3]).sum(axis=0, dtype=np.float64)
        return total

    def switching(self, text: bytes) -> float:
        """The code length, in bits, of a text whose every ``WINDOW`` bytes are coded in the language that suits them best: a text of several
        learned languages is as short as one of a single language. The choice itself costs the bits of the number of languages."""
        total = 0.0
        padded = self.symbol[np.frombuffer(b"   " + text, dtype=np.uint8)]
        for begin in range(0, len(text), CHUNK):
            rows = self._rows(padded[begin : begin + CHUNK + 3])
            sums = np.add.reduceat(rows, np.arange(0, len(rows), WINDOW), axis=0)
            total += float(sums.min(axis=1).sum(dtype=np.float64)) + len(sums) * np.log2(len(self.langs))
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the shortest code and its share of the languages' probabilities; a tie goes to the first by name."""
        form = letters(text)
        if not self.langs or not form.strip():
            return UNKNOWN, 0.0
        bits = self.lengths(form)
        best = int(bits.argmin())
        return self.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def predict(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """(id, held_out, lang_pred, score) per row.

    Held out, and never learned from, are rows whose crc32 of the id as text is 2 modulo 4. The trees learn from a hash sample of
    the other labelled rows, about ``sample_rows`` a language; only their distinct grams reach the driver. Every whole text is scored.

    The score is the share of the language among the probabilities of whole texts, so it is 1.0 for nearly any text of more than a few words.

    A null text, one without a letter, and any text when no row is labelled get ``und`` and score 0. A null id is not held out and not
    learned from. Repeated rows each return their row. An empty table gives no rows. Other columns are not read.
    """
    counts = sum(count(docs, id_col, text_col, lang_col, sample_rows), [])
    kind = docs.schema[id_col].dataType.simpleString()
    shared, key = docs.sparkSession.sparkContext.broadcast(counts), uuid.uuid4().hex
    rows = docs.select(F.col(f"`{id_col}`"), is_held_out(F.col(f"`{id_col}`")).alias("held_out"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        trees = per_worker(("trees", key), lambda: Trees(shared.value, max_cells))
        for batch in batches:
            made = [trees.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                [id_col, "held_out", "lang_pred", "score"],
            )

    return map_batches(rows, run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


class Fit:
    """The trees of all counts, which tell the language, and those of each half, which measure texts of the other half: a text that was learned
    would find its own bytes in the trees, however odd it is."""

    def __init__(self, halves: tuple[Counts, Counts], max_cells: int):
        self.whole = Trees(halves[0] + halves[1], max_cells)
        self.others = [Trees(halves[1], max_cells), Trees(halves[0], max_cells)]

    def bits(self, form: bytes, half: int) -> float:
        """The switching code length of letters, by the whole trees where the other half lacks a language."""
        trees = self.others[half] if self.others[half].langs == self.whole.langs else self.whole
        return trees.switching(form)


def bits_a_byte(sketch: list[tuple[str, int, int]]) -> dict[str, float]:
    """The limit of each language, from (language, bucket, rows)."""
    by_lang: dict[str, list[tuple[int, int]]] = {}
    for lang, bucket, n in sketch:
        by_lang.setdefault(lang, []).append((bucket, n))
    found = {}
    for lang, parts in by_lang.items():
        buckets, n = np.array(sorted(parts)).T
        middle, upper = ((buckets[np.searchsorted(n.cumsum(), share * n.sum())] + 1) / STEPS for share in (0.5, 0.75))
        found[lang] = float(middle + max(LEAST_BITS, WIDE * (upper - middle)))
    return found


def keep_known(docs: DataFrame, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` whose text has letters, a language of at least ``min_score``, and a code length within the limit of the language;
    columns stay as they are.

    The score only compares the languages that were learned, so gibberish and other languages have a high one too. The code length tells
    them: its limit comes from a sketch, counts per bucket, of the bits a byte of all labelled rows of the language that are not held out.

    Scoring is part of the pass over the rows, so that repeated and null ids need no key. The trees learn as in :func:`predict`.
    """
    halves = count(docs, id_col, text_col, lang_col, options.get("sample_rows", SAMPLE_ROWS))
    shared, key = docs.sparkSession.sparkContext.broadcast(halves), uuid.uuid4().hex
    max_cells = options.get("max_cells", MAX_CELLS)

    def measured(batches):
        fit = per_worker(("fit", key), lambda: Fit(shared.value, max_cells))
        for batch in batches:
            found: dict[tuple[str, int], int] = {}
            for half, lang, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                form = letters(text)
                if form.strip() and fit.whole.langs:
                    at = lang, int(fit.bits(form, half) / len(form) * STEPS)
                    found[at] = found.get(at, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[0] for a in found], pa.string()), pa.array([a[1] for a in found], pa.int64()), pa.array(list(found.values()), pa.int64())], ["lang", "bucket", "n"]
            )

    rows = _learnable(docs, id_col, text_col, lang_col).select("half", "lang", "text")
    sketch = map_batches(rows, measured, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    limits = bits_a_byte([tuple(r) for r in sketch.collect()])

    def known(text: str | None, half: int) -> bool:
        fit = per_worker(("fit", key), lambda: Fit(shared.value, max_cells))
        lang, score = fit.whole.predict(text)
        if score < min_score or lang == UNKNOWN:
            return score >= min_score
        form = letters(text)
        return lang not in limits or fit.bits(form, half) <= limits[lang] * len(form) + SPARE_BITS

    @F.pandas_udf("boolean")
    def keeps(texts, halves):
        return texts.combine(halves, known).astype("bool")

    text = F.col(f"`{text_col}`")
    return docs.where(keeps(text, half_of(text)))
