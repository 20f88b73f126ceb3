"""Benchmark decontamination: q-gram lemma filtering over diagonal bands, verified by banded alignment.

Benchmark items are cut into overlapping windows. A window of m characters that occurs in a text with at most k edits
shares at least m + 1 - q (k + 1) of its q-grams with it, all on diagonals that differ by at most k. The q-grams of a
text are looked up in an index of the items; hits are counted in overlapping diagonal bands; windows that meet the
bound are aligned within the band, all of a block of texts at once. Windows that items share, and pieces of text that repeat, are dealt with once, and hits
are counted in parts of bounded size, so text that repeats one character costs no product of its places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tesserae.llm.blocks import cuts, texts

Q = 10
TABLE_BITS = 22
#: Hits that are worked out at once.
HITS = 1_000_000


def normalised(text: bytes) -> bytes:
    """Lower-cased A-Z, one space for each run of white space."""
    return b" ".join(text.lower().split())


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``Q`` bytes at each place (``Q`` is between 8 and 16)."""
    n = len(data) - Q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    padded = np.r_[data, np.zeros(16, np.uint8)]
    eight = np.empty(len(data) // 8 * 8 + 8, np.uint64)
    for at in range(8):
        eight[at::8] = padded[at : at + len(eight)].view(np.uint64)
    h = (eight[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ ((eight[Q - 8 :][:n] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(5))
    return (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)


def budget(length: int, rate: float) -> int:
    """Edits that a window may have: its share, and few enough that the q-gram bound is 1 or more."""
    return max(0, min(int(length * rate), length // Q - 1))


#: Scripts that put no space between words, as ranges of code points.
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


def spaced(c: str) -> bool:
    """Whether a character is part of a word in a script that puts spaces between words."""
    return c.isalnum() and not any(lo <= ord(c) <= hi for lo, hi in UNSPACED)


def tells(item: str, words: int = 2, characters: int = 4) -> bool:
    """Whether a short item can be told from a chance word: of some words, or of some characters without spaces."""
    return item.count(" ") + 1 >= words or sum(c.isalnum() and not spaced(c) for c in item) >= characters


@dataclass
class Index:
    """Benchmark items end to end, their different windows and the q-grams of those, sorted by hash and place.

    Equal windows stand once, so what items have in common (rulers, set phrases) is matched once.
    """

    data: np.ndarray
    starts: np.ndarray  # of windows
    sizes: np.ndarray
    edits: np.ndarray  # budget of each window
    owners: list[list[int]]  # items of each window, one entry for each time that an item has it
    hashes: np.ndarray
    places: np.ndarray  # of the q-grams, in ``data``
    codes: np.ndarray  # number of the hash times (length of data + 1), plus the place
    present: np.ndarray
    whole: dict[bytes, list[int]]  # items that only a text as a whole can be
    short: dict[str, list[int]]  # items that are found as they are, between word borders

    @classmethod
    def build(cls, items: list[tuple[object, bytes]], window: int, stride: int, rate: float, least: int) -> Index:
        data, starts, sizes, owners, whole, short, at = [], [], [], [], {}, {}, 0
        known: dict[bytes, int] = {}
        for n, (_, text) in enumerate(items):
            clean = normalised(text)
            if len(clean) < max(least, Q):
                if clean and tells(clean.decode()):
                    short.setdefault(clean.decode(), []).append(n)
                elif clean:
                    whole.setdefault(clean, []).append(n)
                continue
            last = max(0, len(clean) - window)
            for s in sorted({*range(0, last + 1, stride), last}):
                part = clean[s : s + window]
                if part not in known:
                    known[part] = len(owners)
                    owners.append([])
                    starts.append(at + s)
                    sizes.append(len(part))
                owners[known[part]].append(n)
            data.append(clean)
            at += len(clean)
        every = np.frombuffer(b"".join(data), np.uint8)
        ints = lambda x: np.array(x, np.int64)
        edge = np.zeros(len(every) + 1, np.int64)
        np.add.at(edge, ints(starts), 1)
        np.add.at(edge, ints(starts) + ints(sizes) - Q + 1, -1)
        places = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        hashes = gram_hashes(every)[places] if len(places) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        hashes, places = hashes[order], places[order]
        number = np.cumsum(np.r_[0, hashes[1:] != hashes[:-1]]) if len(hashes) else places
        present = np.zeros(1 << TABLE_BITS, bool)
        present[hashes >> np.uint64(64 - TABLE_BITS)] = True
        edits = ints([budget(s, rate) for s in sizes])
        return cls(every, ints(starts), ints(sizes), edits, owners, hashes, places.astype(np.int32), number * (len(every) + 1) + places, present, whole, short)

    def automaton(self) -> ahocorasick.Automaton | None:
        """Finds the short items."""
        if not self.short:
            return None
        found = ahocorasick.Automaton()
        for item, owners in self.short.items():
            found.add_word(item, (item, owners))
        found.make_automaton()
        return found


def short_items(automaton: ahocorasick.Automaton, text: str) -> set[int]:
    """Short items in a normalised text; a letter that goes on beside one hides it."""
    found: set[int] = set()
    for end, (item, owners) in automaton.iter(text):
        begin, after = end + 1 - len(item), end + 1
        inside = (begin and spaced(text[begin - 1]) and spaced(item[0])) or (after < len(text) and spaced(text[after]) and spaced(item[-1]))
        if not inside:
            found.update(owners)
    return found


def banded_distances(a: np.ndarray, lengths: np.ndarray, b: np.ndarray, band: int, limits: np.ndarray) -> np.ndarray:
    """Least edits that turn each row of ``a`` (its first ``lengths``) into some part of the row of ``b``, along diagonals
    0 to ``band``; over the row's limit: limit + 1. Zeros in ``b`` are no characters."""
    big = limits[:, None] + 1
    steps = np.arange(band + 1)
    row = np.zeros((len(a), band + 1), np.int64)  # free start anywhere in the band
    b = np.pad(b, ((0, 0), (0, max(0, a.shape[1] + band - b.shape[1]))))
    for i in range(a.shape[1]):
        met = b[:, i : i + band + 1]
        change = np.where(met == 0, big, row + (met != a[:, i : i + 1]))
        drop = np.concatenate([row[:, 1:], big], axis=1) + 1  # a's character is left out
        best = np.minimum(change, drop)
        best = np.minimum.accumulate(best - steps, axis=1) + steps  # b's characters are left out
        row = np.where((i < lengths)[:, None], best, row)
    return np.minimum(row.min(1), limits + 1)


def _slices(at: np.ndarray, n: np.ndarray, margin: int) -> Iterator[tuple[int, int]]:
    """Ranges of the text's q-grams that stand for at most ``HITS`` hits, or span little; neighbours overlap by a match."""
    total, begin = np.r_[0, np.cumsum(n)], 0
    while begin < len(at):
        end = max(int(np.searchsorted(total, total[begin] + HITS, "right")) - 1, int(np.searchsorted(at, at[begin] + 4 * margin, "right")))
        yield begin, min(end, len(at))
        if end >= len(at):
            return
        begin = max(begin + 1, int(np.searchsorted(at, at[end - 1] - margin)))


def _spans(index: Index, hits: int) -> Iterator[tuple[int, int]]:
    """Ranges of windows; several if a slice of the text has more than ``HITS`` hits with all of them."""
    step = -(-len(index.starts) // max(1, -(-hits // HITS)))
    for first in range(0, len(index.starts), step):
        yield first, min(first + step, len(index.starts))


def _candidates(index: Index, at: np.ndarray, number: np.ndarray, windows: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``first place, window`` of the bands of the text in which a window has enough q-grams."""
    total = len(index.data) + 1
    lo_place, hi_place = int(index.starts[windows[0]]), int((index.starts + index.sizes)[windows[0] : windows[1]].max())
    lo = np.searchsorted(index.codes, number * total + lo_place)
    n = np.searchsorted(index.codes, number * total + hi_place) - lo
    pick = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    place, where = np.repeat(at, n), index.places[pick].astype(np.int64)
    wide = int(index.edits.max()) + 1
    diagonal = place - where + total  # over 0
    least = int((index.sizes + 1 - Q * (index.edits + 1)).min())
    span = int(index.sizes.max()) - Q
    for half in (0, 1):  # bands of twice the width, each shifted by half: a match lies whole in one of them
        band = (diagonal + wide * half) // (2 * wide)
        code = np.unique(band * total + where)  # each q-gram of an item counts once in a band
        # hits from which a window's worth of places holds enough others, and the windows about them
        dense = np.flatnonzero(np.searchsorted(code, code + span, "right") - np.arange(len(code)) >= max(1, least))
        if not len(dense):
            continue
        band, where_ = code[dense] // total, code[dense] % total
        first = np.clip(np.searchsorted(index.starts, where_ - span, "left"), *windows)
        last = np.clip(np.searchsorted(index.starts, where_, "right"), *windows)
        many = np.maximum(0, last - first)
        window = np.repeat(first - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        pairs = np.unique(np.repeat(band, many) * len(index.starts) + window)
        band, window = pairs // len(index.starts), pairs % len(index.starts)
        begin = band * total + index.starts[window]
        count = np.searchsorted(code, begin + index.sizes[window] - Q, "right") - np.searchsorted(code, begin, "left")
        able = count >= np.maximum(1, index.sizes[window] + 1 - Q * (index.edits[window] + 1))
        yield band[able] * 2 * wide - wide * half - total + index.starts[window[able]], window[able]


def _aligned(index: Index, data: np.ndarray, start: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Edits of each window about its place in the text; equal pieces of text are aligned with a window once."""
    wide, most = int(index.edits.max()) + 1, int(index.sizes[w].max())
    cells = start[:, None] + np.arange(most + 2 * wide)
    part = np.where((cells >= 0) & (cells < len(data)), data[np.clip(cells, 0, len(data) - 1)], 0).astype(np.uint8)
    both = np.ascontiguousarray(np.concatenate([w.astype(np.int64)[:, None].view(np.uint8).reshape(len(w), 8), part], axis=1))
    _, first, of = np.unique(both.view(f"V{both.shape[1]}").ravel(), return_index=True, return_inverse=True)
    w, part = w[first], part[first]
    rows = index.data[np.minimum(index.starts[w][:, None] + np.arange(most), len(index.data) - 1)]
    return banded_distances(rows, index.sizes[w], part, 2 * wide - 1, index.edits[w])[of]


def matches(index: Index, data: np.ndarray, ends: np.ndarray, batch: int = 4096) -> dict[tuple[int, int], tuple[int, int]]:
    """(text, item) -> (windows found, fewest edits), for texts laid end to end with a gap of zeros between them.

    Hits are worked out in parts of bounded size, whatever repeats in a text or in the benchmark.
    """
    if not len(index.hashes) or len(data) < Q:
        return {}
    h = gram_hashes(data)
    at = np.flatnonzero(index.present[h >> np.uint64(64 - TABLE_BITS)])
    h = h[at]
    lo = np.searchsorted(index.hashes, h, "left")
    there = index.hashes[np.minimum(lo, len(index.hashes) - 1)] == h
    at, lo, h = at[there], lo[there], h[there]
    n = np.searchsorted(index.hashes, h, "right") - lo
    number = index.codes[lo] // (len(index.data) + 1) if len(lo) else lo
    wide = int(index.edits.max()) + 1
    seen: dict[tuple[int, int], int] = {}
    for begin, end in _slices(at, n, int(index.sizes.max()) + 2 * wide):
        for windows in _spans(index, int(n[begin:end].sum())):
            for start, window in _candidates(index, at[begin:end], number[begin:end], windows):
                for k in range(0, len(start), batch):
                    s, w = start[k : k + batch], window[k : k + batch]
                    edits = _aligned(index, data, s, w)
                    ok = np.flatnonzero(edits <= index.edits[w])
                    text = np.searchsorted(ends, np.clip(s[ok] + wide + index.sizes[w[ok]] // 2, 0, len(data) - 1), "right")
                    for t, x, e in zip(text.tolist(), w[ok].tolist(), edits[ok].tolist()):
                        seen[t, x] = min(e, seen.get((t, x), e))
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for (t, x), e in seen.items():
        for i in index.owners[x]:
            many, least = found.get((t, i), (0, e))
            found[t, i] = (many + 1, min(least, e))
    return found


def blocks_of(benchmark: DataFrame, text: str, key: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark's items in blocks of bounded size, read one after the other."""
    block, size = [], 0
    for row in benchmark.select(key, F.col(text).cast("string").alias("t")).where("t IS NOT NULL").orderBy(key, "t").toLocalIterator():
        data = row["t"].encode()
        if block and size + len(data) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row[0], data))
        size += len(data)
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    window: int = 64,
    stride: int = 8,
    rate: float = 0.08,
    least: int = 16,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """``key, item_key, n_regions, edits`` for each row and benchmark item of which a window occurs in the text.

    Items are cut into windows of ``window`` characters (bytes of the normalised text) that begin every ``stride``
    characters, so an excerpt of ``window + stride - 1`` characters holds a whole one; a shorter item is one window. A
    window may differ in ``rate`` of its characters, but not in so many that no q-gram need be left. An item below
    ``least`` characters is found as it is, between word borders (scripts without spaces have them everywhere); if it
    has one word or below four characters of such scripts, it is a chance word and counts where it is the whole text.
    ``n_regions`` counts windows, ``edits`` is the fewest of one. The benchmark goes to the tasks in blocks of
    ``block_bytes`` (about 20 bytes for each, and a table of 4 MB); each block is one pass over the texts. Null and
    empty texts match nothing, equal rows each get their results, and an empty benchmark gives none.
    """
    if not (window >= 2 * Q and stride >= 1 and least >= Q and 0 <= rate < 1):
        raise ValueError(f"a window needs {2 * Q} characters, least {Q}, stride 1 and rate a share below 1")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    kind, item_kind = rows.schema["key"].dataType, benchmark.schema[item_key].dataType
    schema = f"key {kind.simpleString()}, item int, n_regions long, edits long"
    out = None
    for block in blocks_of(benchmark, item_text, item_key, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(Index.build(block, window, stride, rate, least))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            gap, automaton = b"\0" * (2 * window), index.value.automaton()
            for part in cuts(batches, "text", 1 << 20):
                clean = [normalised(t) for t in texts(part.column("text"))]
                ends = np.cumsum([len(t) + len(gap) for t in clean])
                hits = matches(index.value, np.frombuffer(gap.join([*clean, b""]), np.uint8), ends)
                if index.value.whole:
                    hits |= {(t, i): (1, 0) for t, c in enumerate(clean) for i in index.value.whole.get(c, ())}
                if automaton:
                    hits |= {(t, i): (1, 0) for t, c in enumerate(clean) for i in short_items(automaton, c.decode())}
                which = sorted(hits)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array([t for t, _ in which], pa.int64())),
                        pa.array([i for _, i in which], pa.int32()),
                        pa.array([hits[w][0] for w in which], pa.int64()),
                        pa.array([hits[w][1] for w in which], pa.int64()),
                    ],
                    names=["key", "item", "n_regions", "edits"],
                )

        names = docs.sparkSession.createDataFrame([(i, k) for i, (k, _) in enumerate(block)], f"item int, item_key {item_kind.simpleString()}")
        got = rows.mapInArrow(run, schema).join(F.broadcast(names), "item").select(F.col("key").alias(key), F.col("item_key").alias(item_key), "n_regions", "edits")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"`{key}` {kind.simpleString()}, `{item_key}` {item_kind.simpleString()}, n_regions long, edits long")
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which a benchmark item occurs; null keys are never dropped."""
    key = options.get("key", "doc_id")
    found = contaminated(docs, benchmark, **options).select(key).distinct()
    return docs.join(found, key, "left_anti")
