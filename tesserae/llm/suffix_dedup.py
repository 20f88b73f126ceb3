"""Suffix-array dedup: bytes covered by a 50-byte string that a document with a smaller key has too.

Of equal texts only the one with the smallest key is compared; the others go whole. Texts are packed into blocks, one
row each. Every 50-byte window is owned by the smallest hash among its 24-byte grams, so equal windows have owners with
equal grams at the same offset. A first shuffle counts owners; the windows of owners that two texts have go on as
segments in a second one, each distinct segment of a block once, to a task that sees all segments of an owner. There
the windows are judged by a suffix array, built linearly by grouping: groups of suffixes that share a Lyndon prefix
are processed in descending order, each splitting the groups of the previous smaller suffixes, and then every group's
order is emitted by walking the same pointers from the suffixes already placed, without renaming and recursion.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from tesserae.functions.storage import cut, cut_parts, discard
from tesserae.llm.blocks import cuts, utf8

LENGTH = 50
GRAM = 24
#: Grams of a window; most windows of an owner; most bytes of context on a side of it.
REACH = LENGTH - GRAM + 1
WIDTH = 2 * LENGTH - GRAM + 4  # bytes of the longest segment, up to a multiple of 8
BLOCK = 2 << 20
_CHUNK = 1 << 18
#: Bytes of text whose owners one task of a shuffle takes.
SHARE = 16 << 20
#: An owner in more texts than this goes on as single windows, which spread over tasks by what they hold.
HOT = 10_000
#: Symbols of a suffix array, about.
ARRAY = 1 << 17
_HOT_MARK = 128
_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)
_M1, _M2, _32 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at each place."""
    n = len(data) - GRAM + 1
    padded = np.r_[data, np.zeros(16, np.uint8)]
    eight = np.empty(len(data) // 8 * 8 + 8, np.uint64)
    for at in range(8):
        eight[at::8] = padded[at : at + len(eight)].view(np.uint64)
    h = np.zeros(n, np.uint64)
    for at in range(0, GRAM, 8):
        h ^= eight[at : at + n]
        h *= _M1
        h ^= h >> _32
    return h * _M2


def owners(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one owner: ``text, first window, windows, owner, hash``; places are in ``data``.

    ``starts`` has where each text begins, and the end. The hash has its halves swapped: owners are chosen by the
    upper one, so it is the lower one that is even.
    """
    found = [[np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]]
    last = len(data) - LENGTH + 1
    for a in range(0, last, _CHUNK):
        b = min(a + _CHUNK, last)
        h = gram_hashes(data[a : b + LENGTH - 1])
        value, span = (h & _HIGH) | np.arange(len(h), dtype=np.uint64), 1
        while span < REACH:  # leftmost smallest of the window's hashes, by doubling
            step = min(span, REACH - span)
            value = np.minimum(value[: len(value) - step], value[step:])
            span += step
        owner = (value & _LOW).astype(np.int64)
        text = np.repeat(np.arange(len(starts) - 1), np.diff(np.clip(starts, a, b)))
        inside = starts[1:][text] - np.arange(a, b) >= LENGTH
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])])
        count = np.diff(np.r_[new, b - a])
        new, count = new[inside[new]], count[inside[new]]
        hashes = h[owner[new]]
        found.append([text[new], new + a, count, owner[new] + a, hashes << _32 | hashes >> _32])
    return tuple(np.concatenate(x) for x in zip(*found))


def suffix_order(text: list[int]) -> list[int]:
    """The suffix array of integers whose last one is the smallest and occurs once.

    First the groups: suffixes with equal longest Lyndon prefixes, in order. All groups above the present one are
    final. Each of its suffixes points to the nearest one before it that is in a lower group; the ones pointed at
    have a longer Lyndon prefix now and leave their group for a new one right above it, those pointed at more often
    further up. Then the order: reading the array from the smallest suffix on, the one before the suffix just read is
    the next of its group, and so are those its pointers lead to.
    """
    n = len(text)
    first: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        first.setdefault(c, []).append(i)
    members = [first[c] for c in sorted(first)]
    size = [len(m) for m in members]
    group = [0] * n
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    lower = list(range(-1, len(members) - 1))
    higher = [*range(1, len(members)), -1]
    smaller = [-1] * n
    done = bytearray(n)
    g = len(members) - 1
    while g >= 0:
        own = members[g]
        if len(own) != size[g]:
            own = [i for i in own if group[i] == g]
        for i in own:
            done[i] = 1
        pointed: list[int] = []
        times: list[int] = []
        before = -1
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            if j == before:
                if j >= 0:
                    times[-1] += 1
            else:
                before = j
                pointed.append(j)
                times.append(1)
        for t in sorted(set(times), reverse=True) if len(times) > 1 else times:
            to: dict[int, int] = {}
            for j, many in zip(pointed, times):
                if many != t:
                    continue
                q = group[j]
                new = to.get(q)
                if new is None:
                    if size[q] == 1:  # alone in its group: the group is its new one
                        continue
                    new = to[q] = len(members)
                    members.append([])
                    size.append(0)
                    up = higher[q]
                    higher.append(up)
                    lower.append(q)
                    higher[q] = new
                    if up >= 0:
                        lower[up] = new
                members[new].append(j)
                size[new] += 1
                size[q] -= 1
                group[j] = new
        g = lower[g]
    head = [0] * len(members)
    total, g = 0, 0
    while g >= 0:  # the group of the last suffix, alone, is the lowest
        head[g] = total
        total += size[g]
        g = higher[g]
    order = [0] * n
    order[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for k in range(n):
        i = order[k] - 1
        while i >= 0 and not placed[i]:  # smaller ones have their place already
            placed[i] = 1
            g = group[i]
            order[head[g]] = i
            head[g] += 1
            i = smaller[i]
    return order


def least_of_windows(parts: list[np.ndarray], windows: np.ndarray, length: int, least: np.ndarray) -> np.ndarray:
    """For the windows of each part (those that begin at 0 to ``windows`` - 1), end to end: the smallest key of a part
    that has the same ``length`` symbols as a window. Symbols are over 1."""
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(np.r_[0, sizes[:-1] + 1])
    text = np.zeros(int(sizes.sum()) + len(parts) + length, np.int64)
    text[: starts[-1] + sizes[-1] + 1] = np.concatenate([np.r_[p, 1] for p in parts])
    order = np.array(suffix_order(text[: starts[-1] + sizes[-1] + 2].tolist()), np.int64)
    number = np.full(len(text), -1, np.int64)  # of the window that begins at each place
    places = np.repeat(starts - np.cumsum(np.r_[0, windows[:-1]]), windows) + np.arange(windows.sum())
    number[places] = np.arange(len(places))
    order = order[number[order] >= 0]
    same = np.ones(len(order) - 1, bool)
    for k in range(length):
        same &= text[order[1:] + k] == text[order[:-1] + k]
    new = np.flatnonzero(np.r_[True, ~same])
    keys = np.repeat(least, windows)[number[order]]
    out = np.empty(len(order), np.int64)
    out[number[order]] = np.repeat(np.minimum.reduceat(keys, new), np.diff(np.r_[new, len(order)]))
    return out


def _each(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, end to end."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _matrix(data: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of ``WIDTH`` bytes, zero beyond their length."""
    out = np.zeros((len(first), WIDTH), np.uint8)
    row = np.repeat(np.arange(len(first)), lengths)
    at = _each(lengths)
    out[row, at] = data[np.repeat(first, lengths) + at]
    return out


def _row_hash(mat: np.ndarray, *more: np.ndarray) -> np.ndarray:
    h = np.zeros(len(mat), np.uint64)
    for word in (*mat.view(np.uint64).T, *(m.astype(np.uint64) for m in more)):
        h = (h ^ word) * _M1
        h ^= h >> _32
    return h * _M2


def _kinds(order: np.ndarray, mat: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's kind (equal rows that ``order`` puts next to each other), and a row of each kind."""
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (mat[a] != mat[b]).any(1)
    for m in more:
        new[1:] |= m[a] != m[b]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return kind, order[new]


def _extremes(kind: np.ndarray, count: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    least, most = np.full(count, np.iinfo(np.int64).max), np.full(count, np.iinfo(np.int64).min)
    np.minimum.at(least, kind, lo)
    np.maximum.at(most, kind, hi)
    return least, most


def _by_share(r: np.ndarray, shares: int) -> np.ndarray:
    return ((r >> _32) * np.uint64(shares) >> _32).astype(np.int64)


def _owner_counts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct owners in order, and how many texts have each."""
    text, _, _, _, r = owners(data, starts)
    order = np.argsort(r, kind="stable")
    r, text = r[order], text[order]
    other = np.r_[True, r[1:] != r[:-1]] if len(r) else np.zeros(0, bool)
    fresh = other | np.r_[True, text[1:] != text[:-1]] if len(r) else other
    at = np.flatnonzero(other)
    return r[at], np.add.reduceat(fresh.astype(np.int64), at) if len(at) else at


BLOCKS = "kind int, block long, keys array<long>, sizes array<long>, data binary, owners array<struct<share:int,r:binary,n:binary>>"
#: Bytes of an owner's hash that are enough to count it: two that agree in them count as shared, and are compared later.
SHORT = 6


def _pack(shares: int):
    """Texts to blocks: a row of kind 0 with the texts, and one of kind 1 with the distinct owners by share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("share", pa.int32()), ("r", pa.binary()), ("n", pa.binary())]))
        for block in cuts(batches, "text", BLOCK):
            data, starts = utf8(block.column("text"))
            r, n = _owner_counts(data, starts)
            share = _by_share(r, shares)
            edges = np.flatnonzero(np.r_[True, share[1:] != share[:-1]]) if len(r) else np.zeros(0, np.int64)
            short = r.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - SHORT :]
            n = np.minimum(n, 255).astype(np.uint8)
            cut_up = [{"share": int(share[a]), "r": short[a:b].tobytes(), "n": n[a:b].tobytes()} for a, b in zip(edges, [*edges[1:], len(r)])]
            number = secrets.randbits(63)
            columns = ([0, 1], [number] * 2, [block.column("key").to_numpy(), None], [np.diff(starts), None], [data.tobytes(), None], [None, cut_up])
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "block", "keys", "sizes", "data", "owners"])

    return run


def _numbers(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _shared(rows: pa.Table, hot: int) -> pa.Table:
    """One share of owners, a row for each block: 1 for every owner that two texts have, 2 if over ``hot`` have it."""
    n = _numbers(rows["n"], "u1")
    r = []
    for x in rows["r"].to_pylist():
        wide = np.zeros((len(x) // SHORT, 8), np.uint8)
        wide[:, 8 - SHORT :] = np.frombuffer(x, np.uint8).reshape(-1, SHORT)
        r.append(wide.view("<u8").ravel())
    every, count = np.concatenate(r), np.concatenate(n).astype(np.int64)
    order = np.argsort(every, kind="stable")
    at = np.flatnonzero(np.r_[True, every[order[1:]] != every[order[:-1]]])
    total = np.add.reduceat(count[order], at)
    flag = np.empty(len(every), np.uint8)
    flag[order] = np.repeat(np.where(total < 2, 0, np.where(total <= hot, 1, 2)).astype(np.uint8), np.diff(np.r_[at, len(every)]))
    flags = np.split(flag, np.cumsum([len(x) for x in r])[:-1])
    keep = pa.array([i for i, f in enumerate(flags) if f.any()], pa.int64())
    return pa.table({"block": rows["block"].take(keep), "share": rows["share"].take(keep), "flags": pa.array([flags[i].tobytes() for i in keep.to_pylist()], pa.binary())})


def _block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, bytes and starts of a block."""
    keys = rows["keys"][0].values.to_numpy()
    sizes = rows["sizes"][0].values.to_numpy()
    return keys, np.frombuffer(rows["data"][0].as_buffer(), np.uint8), np.r_[0, np.cumsum(sizes)]


PARTS = "array<struct<share:int,base:int,r:binary,lo:binary,hi:binary,offset:binary,n:binary,bytes:binary>>"
SEGMENTS = f"block long, keys array<long>, sizes array<long>, data binary, first binary, entry binary, parts {PARTS}"
_PARTS = pa.list_(pa.struct([("share", pa.int32()), ("base", pa.int32()), *((c, pa.binary()) for c in ("r", "lo", "hi", "offset", "n", "bytes"))]))


def _segments(shares: int):
    """A block and what it shares: its segments, and each distinct one once with the smallest and greatest key."""

    def run(block: pa.Table, shared: pa.Table) -> pa.Table:
        keys, data, starts = _block(block)
        text, first, n, owner, r = owners(data, starts)
        distinct = np.unique(r)
        flag = np.zeros(len(distinct), np.uint8)
        edges = np.searchsorted(_by_share(distinct, shares), np.arange(shares + 1))
        for share, flags in zip(shared["share"].to_pylist(), _numbers(shared["flags"], "u1")):
            flag[edges[share] : edges[share + 1]] = flags
        of = flag[np.searchsorted(distinct, r)] if len(r) else np.zeros(0, np.uint8)
        whole, hot = np.flatnonzero(of == 1), np.flatnonzero(of == 2)
        # hot ones: every window is a segment of its own
        at, ahead = np.repeat(hot, n[hot]), _each(n[hot])
        begin = np.r_[first[whole], first[at] + ahead]
        which = np.r_[whole, at]
        count = np.r_[n[whole], np.ones(len(at), np.int64)]
        offset = owner[which] - begin
        mark = np.r_[np.zeros(len(whole), np.int64), np.full(len(at), _HOT_MARK)]
        mat = _matrix(data, begin, count + LENGTH - 1)
        hashed = _row_hash(mat, r[which], offset, count)
        share = np.where(mark > 0, _by_share(hashed, shares), _by_share(r[which], shares))
        order = np.lexsort((hashed, share))
        kind, sample = _kinds(order, mat, r[which], offset, count, mark, share)
        lo, hi = _extremes(kind, len(sample), keys[text[which]], keys[text[which]])
        columns = {"r": r[which][sample], "lo": lo, "hi": hi, "offset": (offset | mark)[sample].astype(np.uint8), "n": count[sample].astype(np.uint8)}
        lengths = count[sample] + LENGTH - 1
        ends = np.r_[0, np.cumsum(lengths)]
        flat = mat[sample][np.arange(WIDTH) < lengths[:, None]]
        cut_at = np.flatnonzero(np.r_[True, np.diff(share[sample]) != 0]) if len(sample) else np.zeros(0, np.int64)
        parts = [
            {"share": int(share[sample[a]]), "base": int(a)} | {c: v[a:b].tobytes() for c, v in columns.items()} | {"bytes": flat[ends[a] : ends[b]].tobytes()}
            for a, b in zip(cut_at, [*cut_at[1:], len(sample)])
        ]
        return pa.table(
            {
                **{c: block[c] for c in ("block", "keys", "sizes", "data")},
                "first": pa.array([begin.astype(np.int32).tobytes()], pa.binary()),
                "entry": pa.array([kind.astype(np.int32).tobytes()], pa.binary()),
                "parts": pa.array([parts], _PARTS),
            }
        )

    return run


def _promising(gram: np.ndarray, mat: np.ndarray, offset: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Kinds that agree with another of their gram in enough bytes on one side to share a window with it."""
    half = (LENGTH - GRAM) // 2
    out = np.zeros(len(gram), bool)
    for able, begin in ((offset >= half, offset - half), (n - 1 + LENGTH - GRAM - offset >= half, offset + GRAM)):
        at = np.flatnonzero(able)
        side = mat[at[:, None], begin[at][:, None] + np.arange(half)]
        h = _row_hash(np.ascontiguousarray(np.pad(side, ((0, 0), (0, 16 - half)))), gram[at])
        order = np.argsort(h)
        twin = h[order][1:] == h[order][:-1]
        out[at[order[1:][twin]]] = out[at[order[:-1][twin]]] = True
    return out


def _judge(rows: pa.Table) -> pa.Table:
    """One share of segments: for runs of windows the smallest key with the same string, where it removes something."""
    r, lo, hi = (np.concatenate(_numbers(rows[c], k)) for c, k in (("r", "<u8"), ("lo", "<i8"), ("hi", "<i8")))
    n = np.concatenate(_numbers(rows["n"], "u1")).astype(np.int64)
    marked = np.concatenate(_numbers(rows["offset"], "u1")).astype(np.int64)
    hot, offset = marked >= _HOT_MARK, marked % _HOT_MARK
    lengths = n + LENGTH - 1
    mat = _matrix(np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8), np.cumsum(lengths) - lengths, lengths)
    kind, sample = _kinds(np.argsort(_row_hash(mat, r, marked, n)), mat, r, marked, n)
    least, most = _extremes(kind, len(sample), lo, hi)
    mat_k, offset_k, n_k, hot_k = mat[sample], offset[sample], n[sample], hot[sample]
    # kinds with equal owners, by all bytes of it
    gram = np.ascontiguousarray(mat_k[np.arange(len(sample))[:, None], offset_k[:, None] + np.arange(GRAM)]).view(np.uint64)
    order = np.lexsort((*gram.T, r[sample]))
    a, b = order[1:], order[:-1]
    new = np.r_[True, (gram[a] != gram[b]).any(1) | (r[sample][a] != r[sample][b]) | hot_k[a] | hot_k[b]]
    owner = np.empty(len(order), np.int64)
    owner[order] = np.cumsum(new) - 1
    low, high = _extremes(owner, int(owner.max()) + 1, least, most)
    size = np.bincount(owner)
    several = np.flatnonzero((size[owner] > 1) & (low < high)[owner])
    several = several[_promising(owner[several], mat_k[several], offset_k[several], n_k[several])]
    several = several[np.argsort(owner[several], kind="stable")]
    begin = np.cumsum(n_k) - n_k
    best = np.repeat(least, n_k)  # of every window of every kind
    symbols = n_k + LENGTH - GRAM
    group_ends = np.flatnonzero(np.r_[owner[several][1:] != owner[several][:-1], True]) + 1 if len(several) else []
    at = 0
    sizes = np.cumsum(symbols[several])
    for end in group_ends:
        if sizes[end - 1] - (sizes[at - 1] if at else 0) >= ARRAY or end == len(several):
            now = several[at:end]
            names = np.unique(owner[now], return_inverse=True)[1] + 258
            parts = [np.r_[m[:o].astype(np.int64) + 2, name, m[o + GRAM : o + s].astype(np.int64) + 2] for m, o, s, name in zip(mat_k[now], offset_k[now], symbols[now] + GRAM - 1, names)]
            found = least_of_windows(parts, n_k[now], REACH, least[now])
            best[np.repeat(begin[now], n_k[now]) + _each(n_k[now])] = found
            at = end
    # runs of windows with one verdict, for every segment that has a greater key
    edge = np.ones(len(best), bool)
    edge[1:] = best[1:] != best[:-1]
    edge[begin] = True
    run_at = np.flatnonzero(edge)
    run_kind = np.repeat(np.arange(len(n_k)), n_k)[run_at]
    run_n = np.diff(np.r_[run_at, len(best)])
    run_lo = np.searchsorted(run_kind, np.arange(len(n_k) + 1))
    many = np.diff(run_lo)[kind]
    row = np.repeat(np.arange(len(kind)), many)
    pick = np.repeat(run_lo[kind], many) + _each(many)
    keep = best[run_at[pick]] < hi[row]
    row, pick = row[keep], pick[keep]
    length = np.array([len(x) // 8 for x in rows["r"].to_pylist()], np.int64)
    base = np.array(rows["base"].to_pylist(), np.int64) - (np.cumsum(length) - length)
    entry = row + np.repeat(base, length)[row]
    columns = {"entry": entry.astype(np.int32), "from": (run_at[pick] - begin[run_kind[pick]]).astype(np.uint8), "many": run_n[pick].astype(np.uint8), "least": best[run_at[pick]]}
    edges = np.searchsorted(row, np.r_[0, np.cumsum(length)])
    some = [i for i in range(len(length)) if edges[i] < edges[i + 1]]
    return pa.table({"block": rows["block"].take(pa.array(some, pa.int64())), **{c: pa.array([v[edges[i] : edges[i + 1]].tobytes() for i in some], pa.binary()) for c, v in columns.items()}})


def _remove(block: pa.Table, verdicts: pa.Table) -> pa.Table:
    """The texts of a block without the bytes that are covered."""
    keys, data, starts = _block(block)
    first = np.frombuffer(block["first"][0].as_buffer(), np.int32).astype(np.int64)
    segment = np.frombuffer(block["entry"][0].as_buffer(), np.int32)
    edge = np.zeros(len(data) + 1, np.int32)
    if verdicts.num_rows and len(first):
        entry, begin, many, least = (np.concatenate(_numbers(verdicts[c], k)) for c, k in (("entry", "<i4"), ("from", "u1"), ("many", "u1"), ("least", "<i8")))
        order = np.argsort(entry, kind="stable")
        lo = np.searchsorted(entry[order], segment)
        times = np.searchsorted(entry[order], segment, "right") - lo
        which = np.repeat(np.arange(len(first)), times)
        run = order[np.repeat(lo, times) + _each(times)]
        key = keys[np.searchsorted(starts, first[which], "right") - 1]
        gone = least[run] < key
        at = first[which][gone] + begin[run][gone]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + many[run][gone] + LENGTH - 1, -1)
    out = np.cumsum(edge[:-1]) > 0
    before = np.r_[False, out[:-1]]
    before[starts[:-1][starts[:-1] < len(data)]] = False
    total = np.r_[0, np.cumsum(out)][starts]
    spans = np.r_[0, np.cumsum(out & ~before)][starts]
    kept, sizes = data[~out].tobytes(), np.diff(starts)
    ends = starts - total
    return pa.table(
        {
            "key": pa.array(keys),
            "n_bytes": pa.array(sizes),
            "n_removed": pa.array(np.diff(total)),
            "n_spans": pa.array(np.diff(spans)),
            "kept": pa.array([kept[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()),
        }
    )


def drop_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", hot: int = HOT) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept`` of every row.

    ``kept`` holds the bytes of the UTF-8 text that no 50-byte string covers which also starts in a row with a
    smaller key; keys are integers. Strings are judged on the input and never cross rows. Null texts are empty. Null
    keys are smaller or greater than none: such rows stay whole and remove nothing. Rows with equal keys do not remove
    each other's bytes. Other columns are left out. ``hot`` bears on how the work is dealt out alone.
    """
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} has to be an integer column: the smaller key keeps what two rows share")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    can = F.col("key").isNotNull() & (F.col("n_bytes") >= LENGTH)
    able = rows.where(can).withColumn("version", F.unhex(F.md5("text")))
    first = cut(able.groupBy("version").agg(F.min("key").alias("key"), F.first("n_bytes").alias("n_bytes")))  # of equal texts only the first is compared
    total = first.agg(F.sum("n_bytes")).first()[0] or 0
    shares = max(8, total // SHARE)
    once = able.join(first.select("version", "key"), ["version", "key"], "left_semi").select("key", "text")
    blocks, owned = cut_parts(once.mapInArrow(_pack(shares), BLOCKS), "kind", [0, 1])
    counts = owned.select("block", F.explode("owners").alias("o")).select("block", "o.*")
    flags = cut(counts.groupBy("share").applyInArrow(lambda t: _shared(t, hot), "block long, share int, flags binary"))
    discard([owned])
    segments = cut(blocks.drop("owners").groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(_segments(shares), SEGMENTS))
    discard([blocks])
    parts = segments.select("block", F.explode("parts").alias("p")).select("block", "p.*")
    verdicts = cut(parts.groupBy("share").applyInArrow(_judge, "block long, entry binary, `from` binary, many binary, least binary"))
    judged = segments.drop("parts").groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(_remove, "key long, n_bytes long, n_removed long, n_spans long, kept binary")
    copies = able.select("version", "key", "n_bytes").join(first.select("version", "key"), ["version", "key"], "left_anti")
    gone = copies.select("key", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
    short = rows.where(~can).select("key", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.encode("text", "UTF-8").alias("kept"))
    out = judged.unionByName(gone).unionByName(short)
    return out.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_removed", "n_spans", "kept")
