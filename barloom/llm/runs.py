"""Periodic runs of words from a grammar: Re-Pair, runs across each rule's boundary once, moved to all places of the rule, and merged."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import columns, map_batches

#: Least words of a run; words of texts handled together in a task (more only where one text has more).
LEAST, CHUNK_WORDS = 12, 500_000
#: Candidates whose extents are computed together.
CANDIDATES = 1 << 19
PRIME = 2**31 - 1
Run = tuple[int, int, int]


def re_pair(words: list[int]) -> tuple[list[tuple[int, int]], list[int], int]:
    """(rules, what is left, first rule's symbol): the pair of symbols with most places is replaced by a new symbol until no pair has two.

    Symbols stand in a linked list. The queue orders pairs by the number of their places when they were put there; a pair whose places were
    taken since is put back with the number left.
    """
    n, base = len(words), max(words, default=0) + 1
    symbol, after, before = words + [-1], list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = {}
    for at in range(n - 1):
        places.setdefault((words[at], words[at + 1]), []).append(at)
    queue = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
    heapq.heapify(queue)
    rules: list[tuple[int, int]] = []
    while queue:
        count, pair = heapq.heappop(queue)
        listed = places.get(pair)
        if listed is None:
            continue
        left, right = pair
        standing, end = [], -1
        for at in sorted(listed) if left == right else listed:  # places of one symbol twice may overlap, from left to right every second stands
            if at >= end and symbol[at] == left and after[at] < n and symbol[after[at]] == right:
                standing.append(at)
                if left == right:
                    end = after[at] + 1
        if len(standing) < 2:
            del places[pair]
            continue
        if len(standing) < -count and queue and len(standing) < -queue[0][0]:
            places[pair] = standing if left != right else listed
            heapq.heappush(queue, (-len(standing), pair))
            continue
        del places[pair]
        new = base + len(rules)
        rules.append(pair)
        fresh = set()
        for at in standing:
            other = after[at]
            follow, lead = after[other], before[at]
            symbol[at], symbol[other] = new, -1
            after[at] = follow
            if follow < n:
                before[follow] = at
                key = new, symbol[follow]
                places.setdefault(key, []).append(at)
                fresh.add(key)
            if lead >= 0:
                key = symbol[lead], new
                places.setdefault(key, []).append(lead)
                fresh.add(key)
        for key in fresh:
            held = places[key] = sorted(set(places[key]))
            if len(held) > 1:
                heapq.heappush(queue, (-len(held), key))
    rest, at = [], 0
    while at < n:
        rest.append(symbol[at])
        at = after[at]
    return rules, rest, base


def boundaries(words: list[int], least: int) -> list[tuple[int, int, int, list[int]]]:
    """(start, boundary, end, shifts) of every rule of ``least`` words or more at its first place, with the distances to its other places.

    What Re-Pair leaves is halved again and again, so that it too is rules of two parts, each with one place.
    """
    rules, rest, base = re_pair(words)
    size: list[int] = []
    for left, right in rules:
        size.append(sum(1 if s < base else size[s - base] for s in (left, right)))
    ends = [0]
    placed: list[list[int]] = [[] for _ in rules]
    for s in rest:
        if s >= base and size[s - base] >= least:
            placed[s - base].append(ends[-1])
        ends.append(ends[-1] + (1 if s < base else size[s - base]))
    out = []
    open_ = [(0, len(rest))]
    while open_:
        a, b = open_.pop()
        if b - a > 1 and ends[b] - ends[a] >= least:
            middle = (a + b) // 2
            out.append((ends[a], ends[middle], ends[b], [0]))
            open_ += [(a, middle), (middle, b)]
    for k in range(len(rules) - 1, -1, -1):  # a rule is used by later ones only
        if not placed[k]:
            continue
        left, right = rules[k]
        cut = 1 if left < base else size[left - base]
        for child, shift in ((left, 0), (right, cut)):
            if child >= base and size[child - base] >= least:
                placed[child - base] += [at + shift for at in placed[k]]
        first = placed[k][0]
        out.append((first, first + cut, first + size[k], [at - first for at in placed[k]]))
        placed[k] = []
    return out


def _scattered(x: np.ndarray, seed: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def grams(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    mixed, n = _scattered(ids, 1), len(ids) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    return out


def zones(ids: np.ndarray, part: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of words, each within one ``part``, outside of which no run lies.

    A run's words q apart agree at least/2 times in a row or more, so windows of that many words cover it that come twice in it. Words in no
    window that comes twice in their stretch fall out, until that changes nothing.
    """
    size, n = least // 2, len(ids)
    if n < least:
        return []
    hashed = grams(ids, size)
    live, zone = np.arange(n), part
    while len(live):
        # places whose whole window is live and in one stretch
        first = live[: len(live) - size + 1]
        whole = (live[size - 1 :] - first == size - 1) & (zone[first] == zone[live[size - 1 :]])
        first = first[whole]
        key = _scattered(hashed[first] ^ _scattered(zone[first], 3), 5)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(first), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, first[twice], 1)
        np.add.at(edge, first[twice] + size, -1)
        covered = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(covered):
            return []
        opens = np.ones(len(covered), bool)
        opens[1:] = (covered[1:] != covered[:-1] + 1) | (zone[covered[1:]] != zone[covered[:-1]])
        number = np.cumsum(opens)
        long = np.bincount(number)[number] >= least
        kept, number = covered[long], number[long]
        if len(kept) == len(live):
            starts = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(kept) else np.array([], int)
            ends = np.append(starts[1:], len(kept))
            return [(int(kept[a]), int(kept[b - 1]) + 1) for a, b in zip(starts, ends, strict=True)]
        live, zone = kept, np.zeros(n, np.int64)
        zone[kept] = number
    return []


class Extents:
    """How far two places of ``ids`` agree, forwards and backwards, by prefix sums of a polynomial hash. What it says can only be too long."""

    def __init__(self, ids: np.ndarray, seed: int):
        n = len(ids)
        values = (_scattered(ids, 7 + seed) % np.uint64(PRIME)).astype(np.int64)
        base = int(_scattered(np.array([seed]), 11)[0] % np.uint64(PRIME - 1000)) + 500
        self.power = np.ones(n + 1, np.int64)
        known = 1
        while known <= n:
            step = int(self.power[known - 1]) * base % PRIME
            more = min(known, n + 1 - known)
            self.power[known : known + more] = self.power[:more] * step % PRIME
            known += more
        self.sums = np.zeros(n + 1, np.int64)
        np.cumsum(values * self.power[:n] % PRIME, out=self.sums[1:])
        self.sums %= PRIME

    def _same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether ``length`` words from a and from b > a on agree."""
        one = (self.sums[a + length] - self.sums[a]) % PRIME
        return one * self.power[b - a] % PRIME == (self.sums[b + length] - self.sums[b]) % PRIME

    def forwards(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._reach(a, b, most, 1)

    def backwards(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._reach(a, b, most, -1)

    def _reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        done = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            able = np.flatnonzero(done + step <= most)
            move = done[able] if way > 0 else -done[able] - step
            done[able[self._same(a[able] + move, b[able] + move, step)]] += step
            step >>= 1
        return done


def crossing(ids: np.ndarray, start: np.ndarray, cut: np.ndarray, end: np.ndarray, least: int, extents: Extents) -> np.ndarray:
    """(rule, start, end, period) of every run of words of a rule that crosses its boundary, within the rule's words.

    Where such a run has period q, its words q apart agree in a stretch that touches the boundary, half ``least`` long or more: so a quarter of
    ``least`` words right before or right after the boundary come again q words on or back. Those places are the candidates.
    """
    size, n = least // 4, len(ids)
    hashed = grams(ids, size)
    group = np.unique(hashed, return_inverse=True)[1]
    keys = np.sort(group * n + np.arange(len(group)))
    found = [np.zeros((0, 4), np.int64)]
    for shift in (-size, 0):
        rule = np.flatnonzero((cut + shift >= start) & (cut + shift + size <= end))
        anchor = cut[rule] + shift
        low = np.searchsorted(keys, group[anchor] * n + start[rule])
        count = np.searchsorted(keys, group[anchor] * n + end[rule] - size, "right") - low
        total = np.cumsum(count)
        at = 0
        while at < len(rule):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CANDIDATES, "right")))
            many = count[at:stop]
            r = np.repeat(np.arange(at, stop), many)
            nth = np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many)
            place, home, k = keys[low[r] + nth] % n, anchor[r], rule[r]
            q = np.abs(place - home)
            fit = (q > 0) & (2 * q <= end[k] - start[k])
            q, k, a = q[fit], k[fit], np.minimum(place, home)[fit]
            e = a + q + extents.forwards(a, a + q, end[k] - a - q)
            s = a - extents.backwards(a, a + q, a - start[k])
            run = (e - s >= np.maximum(least, 2 * q)) & (s < cut[k]) & (cut[k] < e)
            found.append(np.stack([k[run], s[run], e[run], q[run]], axis=1))
            at = stop
    out = np.concatenate(found)
    out = out[np.lexsort(out.T[::-1])]
    # multiples of the smallest period have the same extents
    return out[np.append(True, (out[1:, :3] != out[:-1, :3]).any(axis=1))] if len(out) else out


def merge(pieces: np.ndarray) -> list[Run]:
    """Maximal (start, end, period) of pieces of runs: pieces of one period that share a period's words are one run."""
    whole: dict[tuple[int, int], int] = {}
    held = None
    for q, s, e in [*np.unique(pieces[:, [2, 0, 1]], axis=0).tolist(), (0, 0, 0)]:
        if held and held[0] == q and s <= held[2] - q:
            held[2] = max(held[2], e)
            continue
        if held:
            key = held[1], held[2]
            whole[key] = min(whole.get(key, held[0]), held[0])
        held = [q, s, e]
    return sorted((s, e, q) for (s, e), q in whole.items())


def runs_of(ids: np.ndarray, part: np.ndarray, least: int = LEAST) -> list[Run]:
    """All maximal runs (start, end, smallest period) within the parts of ``ids``: ``least`` words or more, and two periods or more."""
    spans = zones(ids, part, least)
    if not spans:
        return []
    text = np.concatenate([ids[a:b] for a, b in spans])
    rules, at = [], 0
    for a, b in spans:
        rules += [(s + at, c + at, e + at, shifts) for s, c, e, shifts in boundaries(ids[a:b].tolist(), least)]
        at += b - a
    start, cut, end = (np.array([r[k] for r in rules], np.int64) for k in range(3))
    seed = 0
    while True:
        pieces = [np.zeros((0, 3), np.int64)]
        for k, s, e, q in crossing(text, start, cut, end, least, Extents(text, seed)).tolist():
            shifts = np.array(rules[k][3], np.int64)
            pieces.append(np.stack([shifts + s, shifts + e, np.full(len(shifts), q)], axis=1))
        found = merge(np.concatenate(pieces))
        # a wrong hash makes a run too long, which shows here
        if all(np.array_equal(text[s : e - q], text[s + q : e]) for s, e, q in found):
            break
        seed += 1
    lengths = np.array([b - a for a, b in spans])
    offset = np.cumsum(lengths) - lengths
    out = []
    for s, e, q in found:
        z = int(np.searchsorted(offset, s, "right")) - 1
        move = spans[z][0] - int(offset[z])
        out.append((s + move, e + move, q))
    return sorted(out)


SCHEMA = "runs array<struct<start: bigint, length: bigint, period: bigint>>, n_words bigint, collapsed string"


def detect(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    reshape: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(<id>, runs, n_words, collapsed) of every row: runs (start, length, period) of the words of its whole text, by start and period, and the words left when of each
    run only the first period stays, joined by one space.

    Words are what stands between blanks, tabs and line ends. A run has a smallest period q, at least ``least`` and 2 q words, and no neighbouring word continues
    it. ``reshape`` may change the words of a row first. A null or empty text has no words, no runs and an empty collapsed text. Rows are judged one by one, so repeated
    rows and null ids come out as they are; an empty table gives no rows. Work is near linear in the words, and a task holds one batch or one text.
    """

    def found(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        sizes = [len(w) for w in words]
        flat = [w for own in words for w in own]
        codes = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.repeat(np.arange(len(words)), sizes)
        starts = np.cumsum([0, *sizes])
        own: list[list[Run]] = [[] for _ in words]
        for s, e, q in runs_of(codes, part, least):
            d = int(part[s])
            own[d].append((s - int(starts[d]), e - int(starts[d]), q))
        texts = []
        for kept, runs in zip(words, own, strict=True):
            if runs:
                stays = np.ones(len(kept), bool)
                for s, e, q in runs:
                    stays[s + q : e] = False
                kept = [kept[i] for i in np.flatnonzero(stays).tolist()]
            texts.append(b" ".join(kept).decode())
        listed = [[{"start": s, "length": e - s, "period": q} for s, e, q in sorted(runs, key=lambda r: (r[0], r[2]))] for runs in own]
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays([ids, pa.array(listed, kind), pa.array(sizes, pa.int64()), pa.array(texts, pa.string())], [id_col, "runs", "n_words", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, first, held = batch.column(0), [], 0, 0
            for at, raw in enumerate(batch.column(1)):
                split = (raw.as_py() or b"").split()
                words.append(split if reshape is None else reshape(ids[at].as_py(), split))
                held += len(words[-1])
                if held >= CHUNK_WORDS:
                    yield found(ids.slice(first, len(words)), words)
                    first, words, held = at + 1, [], 0
            if words:
                yield found(ids.slice(first, len(words)), words)

    named = columns(docs, id_col, text_col)
    kind = dict(named.dtypes)[id_col]
    return map_batches(named.select(F.col(id_col), F.col(text_col).cast("binary")), run, f"`{id_col}` {kind}, {SCHEMA}")
