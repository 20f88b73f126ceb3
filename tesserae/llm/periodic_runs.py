"""Periodic runs of words by internal pattern matching.

All texts of a block share one suffix array over words that are numbered by text, so that nothing matches across texts.
A run of period q holds a block of 2^k words that begins at a multiple of 2^k, together with its copy q words on, for
the level k of q. Each block asks where it occurs again in the windows that the periods of its level leave: its
suffixes are an interval of the suffix array, found while prefixes double, and a wavelet matrix over the array gives
the first place of an interval that is not before a given one (the range successor). In a window of as many places as
a block has words the occurrences are an arithmetic progression, so the first two and the last give all of them. Each
distance is a candidate period; neighbouring blocks with one candidate are joined and the rest is compared word by
word, less than a block to either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tesserae.llm.blocks import cuts, texts


class WaveletMatrix:
    """Numbers below 2^bits, one packed bit vector for each bit from the highest down."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.words, self.before, self.zeros = bits, [], [], []
        for b in range(bits - 1, -1, -1):
            bit = ((values >> b) & 1).astype(np.uint8)
            padded = np.zeros((len(values) // 64 + 1) * 8, np.uint8)
            packed = np.packbits(bit, bitorder="little")
            padded[: len(packed)] = packed
            words = padded.view(np.uint64)
            self.words.append(words)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(words)[:-1], dtype=np.int64)])
            ones = bit == 1
            self.zeros.append(len(values) - int(ones.sum()))
            values = np.r_[values[~ones], values[ones]]

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][w] + np.bitwise_count(self.words[level][w] & low)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of each interval are below x."""
        size, found = hi - lo, np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            one = ((x >> (self.bits - 1 - level)) & 1) == 1
            a, b = self._ones(level, lo), self._ones(level, hi)
            found += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, self.zeros[level] + a, lo - a), np.where(one, self.zeros[level] + b, hi - b)
        return np.where(x >= (1 << self.bits), size, found)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest number (from 0) of each interval."""
        found = np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            low = (hi - b) - (lo - a)
            one = k >= low
            found += np.where(one, 1 << (self.bits - 1 - level), 0)
            k = np.where(one, k - low, k)
            lo, hi = np.where(one, self.zeros[level] + a, lo - a), np.where(one, self.zeros[level] + b, hi - b)
        return found

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least number of each interval that is x or more; -1 if there is none."""
        return self._pick(lo, hi, self.below(lo, hi, x))

    def predecessor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The greatest number of each interval that is below x; -1 if there is none."""
        return self._pick(lo, hi, self.below(lo, hi, x) - 1)

    def _pick(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        there = (k >= 0) & (k < hi - lo)
        found = np.full(len(lo), -1, np.int64)
        found[there] = self.smallest(lo[there], hi[there], k[there])
        return found


def windows(level: int) -> list[tuple[int, int]]:
    """The periods of a level, in windows of at most 2^level distances.

    A run of q words and more beyond its first q (and of six, as runs have twelve words) holds a whole block of the
    level; the periods 1 to 5 and 7 to 14 are those of four words, 6 is that of two.
    """
    size = 1 << level
    if level == 1:
        return [(6, 6)]
    if level == 2:
        return [(1, 4), (5, 5), (7, 10), (11, 14)]
    return [(2 * size - 1, 3 * size - 2), (3 * size - 1, 4 * size - 2)]


def intervals(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffixes that share their first two words with others, in suffix order, and for each level from 1 on the blocks
    ``start, lo, hi`` that occur again: their interval in that order."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    places = np.arange(n)
    rank = np.empty(n, np.int64)  # first place of a suffix's group
    step, kept, levels = 0, None, []

    def regroup(key: np.ndarray) -> np.ndarray:
        """Ranks by equal neighbours; the places that still tie."""
        first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        rank[order[places]] = places[head]
        many = np.bincount(head, minlength=len(key))[head] > 1 if len(key) else first
        return places[many]

    places = regroup(ids[order])
    while len(places):
        own = order[places]
        step = step * 2 or 1
        ahead = np.where(own + step < n, rank[np.minimum(own + step, n - 1)], -1)
        key = rank[own] * (n + 1) + ahead + 1
        by = np.argsort(key, kind="stable")
        order[places] = own[by]
        places = regroup(key[by])
        if kept is None:
            kept = places
        tied = order[places]  # groups stay whole and in place from here on
        block = np.flatnonzero(tied & (2 * step - 1) == 0)
        head = rank[tied]
        lo = np.searchsorted(kept, head[block])
        size = np.searchsorted(head, head[block], "right") - np.searchsorted(head, head[block], "left")
        levels.append((tied[block], lo, lo + size))
    return (order[kept] if kept is not None else np.zeros(0, np.int64)), levels


def _extended(ids: np.ndarray, at: np.ndarray, period: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on (``way`` 1) or before it (-1) are equal to those a period on."""
    n, found, open_ = len(ids), np.zeros(len(at), np.int64), np.arange(len(at))
    width = 4
    while len(open_):
        step = np.arange(min(width, max(4, (1 << 20) // len(open_))))
        here = at[open_, None] + (found[open_, None] + step if way > 0 else -1 - found[open_, None] - step)
        there = here + period[open_, None]
        inside = (here >= 0) & (there < n)
        same = inside & (ids[np.clip(here, 0, n - 1)] == ids[np.clip(there, 0, n - 1)])
        got = np.where(same.all(1), len(step), same.argmin(1))
        found[open_] += got
        open_ = open_[got == len(step)]
        width *= 2
    return found


def _least_periods(runs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """``start, end, period`` by period and start; a run that is found with multiples of its period counts with the smallest."""
    s, e, q = runs
    by = np.lexsort((q, e, s))
    s, e, q = s[by], e[by], q[by]
    new = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])] if len(s) else np.zeros(0, bool)
    s, e, q = s[new], e[new], q[new]
    by = np.lexsort((s, q))
    return s[by], e[by], q[by]


def _progressions(runs: tuple[np.ndarray, ...], n: int, size: int, block: np.ndarray, first: np.ndarray, last: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``block, period`` of the occurrences from ``first`` to ``last``, ``gap`` words apart, that can give a run.

    Three occurrences and more lie in a run of period ``gap``, as does the block; both are known from lower levels. In
    one and the same run distances are multiples of its period. Else a run of the new period maps an end of the one
    to within ``gap`` words of that end of the other, or the two runs touch.
    """
    count = (last - first) // gap + 1
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    b, q = np.repeat(block, count), np.repeat(first - block, count) + nth * np.repeat(gap, count)
    long = np.flatnonzero(count > 2) if size >= 16 else np.zeros(0, np.int64)
    if not len(long):
        return b, q
    s, e, period = runs
    start_of = lambda at: np.searchsorted(period * (n + 1) + s, gap[long] * (n + 1) + at, "right") - 1
    own, other = start_of(block[long]), start_of(first[long])
    kept = np.ones(len(q), bool)
    of = np.full(len(count), -1)
    of[long] = np.arange(len(long))
    of = np.repeat(of, count)
    many = of >= 0
    o, x = own[of[many]], other[of[many]]
    near = np.minimum(np.abs(q[many] - (s[x] - s[o])), np.abs(q[many] - (e[x] - e[o]))) < np.repeat(gap, count)[many]
    kept[many] = (o != x) & (near | (e[o] >= s[x]))
    return b[kept], q[kept]


def runs_of(ids: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, period`` of all runs by start and period; texts end in numbers of their own and share none."""
    suffixes, levels = intervals(ids)
    runs = (np.zeros(0, np.int64),) * 3
    if not len(suffixes):
        return runs
    tree = WaveletMatrix(suffixes, max(1, int(len(ids) - 1).bit_length()))
    for level, (start, lo, hi) in enumerate(levels, 1):
        size = 1 << level
        found = []
        for near, far in windows(level):
            first = tree.successor(lo, hi, start + near)
            there = np.flatnonzero((first >= 0) & (first <= start + far))
            b, l, h, p1, end = start[there], lo[there], hi[there], first[there], start[there] + far
            second = tree.successor(l, h, p1 + 1)
            more = (second >= 0) & (second <= end)
            last = p1.copy()
            last[more] = tree.predecessor(l[more], h[more], end[more] + 1)
            found.append(_progressions(runs, len(ids), size, b, p1, last, np.where(more, second - p1, 1)))
        b, q = (np.concatenate(x) for x in zip(*found))
        if not len(b):
            continue
        by = np.lexsort((b, q))
        b, q = b[by], q[by]
        head = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (b[1:] != b[:-1] + size)])  # of blocks side by side
        tail = np.r_[head[1:], len(b)] - 1
        s, e, q = b[head], b[tail] + size, q[head]
        s, e = s - _extended(ids, s, q, -1), e + _extended(ids, e, q, 1) + q
        able = e - s >= np.maximum(least, 2 * q)
        runs = _least_periods(tuple(np.concatenate(x) for x in zip(runs, (s[able], e[able], q[able]))))
    s, e, q = runs
    by = np.lexsort((q, s))
    return s[by], e[by], q[by]


def numbered(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as numbers that no two texts share, each text with a number of its own at its end, and where
    each text begins (one more than texts)."""
    begins = np.cumsum([0, *(len(w) + 1 for w in split)])
    ids, at = np.empty(begins[-1], np.int64), 0
    for k, words in enumerate(split):
        flat: dict[bytes, int] = {}
        ids[begins[k] : begins[k + 1] - 1] = [flat.setdefault(w, len(flat)) for w in words]
        ids[begins[k] : begins[k + 1] - 1] += at
        at += len(flat) + 1
        ids[begins[k + 1] - 1] = at - 1
    return ids, begins


def measure(block: list[bytes], least: int = 12) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Each text's runs ``start, length, period``, and its words joined by a space without the repeats of runs."""
    split = [t.split() for t in block]
    ids, begins = numbered(split)
    s, e, q = runs_of(ids, least)
    text = np.searchsorted(begins, s, "right") - 1
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, s + q, 1)
    np.add.at(edge, e, -1)
    dropped = np.cumsum(edge[:-1]) > 0
    found: list[list[tuple[int, int, int]]] = [[] for _ in block]
    for t, a, n, p in zip(text.tolist(), (s - begins[text]).tolist(), (e - s).tolist(), q.tolist()):
        found[t].append((a, n, p))
    kept = []
    for k, words in enumerate(split):
        gone = dropped[begins[k] : begins[k + 1] - 1] if found[k] else None
        kept.append(b" ".join(words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]))
    return found, kept


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 12) -> DataFrame:
    """``key, n_words, runs, collapsed`` of every row.

    Words are what stands between ASCII white space, numbered from 0. ``runs`` has ``start, length, period`` of every
    stretch of at least ``least`` (12 or more) words and two periods in which words a period apart are equal, that no
    word beside it extends and that has no smaller period, by start and period. ``collapsed`` is the text's words,
    joined by a space, without those that some run has after its first period. Texts are taken whole; memory is in
    proportion to the longest text, and all texts of a block of 2 MB are searched together. Null and empty texts have
    no words, no runs and an empty ``collapsed``; null keys stay, repeated rows each get their result, other columns
    are left out, an empty table gives none.
    """
    if least < 12:
        raise ValueError("runs of fewer than 12 words need not hold a whole block of their level")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cuts(batches, "text", 2 << 20):
            block = texts(part.column("text"))
            found, kept = measure(block, least)
            ends = np.cumsum([0, *map(len, found)])
            flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(RUN)))
            words = pa.array([len(t.split()) for t in block], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("key"), words, runs, pa.array(kept, pa.binary()).cast(pa.string())], names=["key", "n_words", "runs", "collapsed"])

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("key", key)
