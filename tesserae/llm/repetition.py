"""Quality rules: a base of counts, and suffix-array repetition over the words of each text.

All texts of a block share one suffix array, built over word numbers of their own and with a number of its own at
each text's end, so that no match crosses texts. Prefix doubling keeps the ranks of every power of two; with them the longest common
prefix of any two neighbours is found in vector steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tesserae.llm.blocks import cuts, texts

#: The characters that count as symbols, and the window of the base rule.
SYMBOLS = b"#*$%&|<>"
WINDOW_LOG = 3


def suffix_ranks(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of an integer sequence whose texts end in unique numbers, and the ranks by prefix length 2^k."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.r_[False, ids[order][1:] != ids[order][:-1]]) if n else 0
    levels, step = [rank.astype(np.int32)], 1
    while n and (rank.max() < n - 1 or len(levels) <= WINDOW_LOG):
        ahead = np.full(n, -1, np.int64)
        ahead[:-step] = rank[step:] if step < n else ahead[:-step]
        pair = rank * (n + 1) + ahead + 1
        # only suffixes that still tie can move; they stay within their places
        sizes = np.bincount(rank, minlength=n)
        tied = sizes[rank[order]] > 1
        places = np.flatnonzero(tied)
        order[places] = order[places][np.argsort(pair[order[places]], kind="stable")]
        sorted_pair = pair[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.r_[False, sorted_pair[1:] != sorted_pair[:-1]])
        rank = new
        levels.append(rank.astype(np.int32))
        step *= 2
    return order, levels


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix in order and the one before it (0 for the first)."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        a[same] += 1 << k
        b[same] += 1 << k
        lcp[1:][same] += 1 << k
    return lcp


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each place lies in the union of the given spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + lengths, n), -1)
    return np.cumsum(edge[:-1]) > 0


def measure(block: list[bytes], min_words: int = 5) -> dict[str, np.ndarray]:
    """Counts of each text; see ``repetition``."""
    split = [t.split() for t in block]
    counts = np.array([len(w) for w in split], np.int64)
    doc = np.repeat(np.arange(len(split)), counts + 1)
    flat: list[bytes] = []
    for words in split:
        flat.extend(words)
    n = len(doc)
    ends = np.cumsum(counts + 1) - 1
    is_word = np.ones(n, bool)
    is_word[ends] = False
    ids = np.empty(n, np.int64)
    if flat:
        codes = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        ids[is_word] = codes + doc[is_word] * len(flat)
    ids[ends] = -1 - np.arange(len(ends))
    order, levels = suffix_ranks(ids)
    lcp = neighbour_lcp(order, levels)
    longest = np.zeros(n, np.int64)  # longest string that starts here and occurs again in the text
    np.maximum.at(longest, order, lcp)
    np.maximum.at(longest, order[:-1], lcp[1:])
    left = np.empty(n, np.int64)  # words from here to the end of the text
    left[:] = ends[doc] - np.arange(n)
    longest = np.minimum(longest, left)
    return _summary(doc, longest, counts, min_words) | _plain(block, split, counts)


def _summary(doc: np.ndarray, longest: np.ndarray, counts: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    n, texts_ = len(doc), len(counts)
    found: dict[str, np.ndarray] = {}
    for name, least in (("n_repeat_words", 1 << WINDOW_LOG), ("n_covered", min_words)):
        starts = np.flatnonzero(longest >= least)
        inside = _covered(starts, longest[starts] if name == "n_covered" else np.full(len(starts), least), n)
        found[name] = np.bincount(doc[inside], minlength=texts_).astype(np.int64)
    most = np.zeros(texts_, np.int64)
    np.maximum.at(most, doc, longest)
    return found | {"longest_repeat": most, "n_words": counts}


def _plain(block: list[bytes], split: list[list[bytes]], counts: np.ndarray) -> dict[str, np.ndarray]:
    chars, symbols, dup_lines = [], [], []
    for text, words in zip(block, split):
        joined = b"".join(words)
        chars.append(len(joined.decode("utf-8")))
        symbols.append(sum(joined.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))))
        lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
        dup_lines.append(len(lines) - len(set(lines)))
    return {"word_chars": np.array(chars, np.int64), "n_symbols": np.array(symbols, np.int64), "n_dup_lines": np.array(dup_lines, np.int64)}


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")


def repetition(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_words: int = 5,
    max_covered: float = 0.3,
    max_longest: float = 0.08,
    least_longest: int = 30,
) -> DataFrame:
    """Counts, base verdict and verdict of every text, in words between ASCII white space.

    ``n_covered`` is the union of the maximal repeated substrings of at least ``min_words`` words (every occurrence
    counts; shorter ones than the base rule's windows, so the limit is stricter), ``longest_repeat`` the longest. A text is kept if the base rules hold (20 words; at most 30 % of words
    in repeated 8-word windows), at most ``max_covered`` of its words are covered, and its longest repeat is within
    ``max_longest`` of its words or below ``least_longest`` words. Null and empty texts have no words, fail the base
    and are not kept. Repeated rows are each judged alone; other columns are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cuts(batches, "text", 3 << 20):
            found = measure(texts(block.column("text")), min_words)
            yield pa.RecordBatch.from_arrays([block.column("key"), *(pa.array(found[c], pa.int64()) for c in COLUMNS)], names=["key", *COLUMNS])

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, " + ", ".join(f"{c} long" for c in COLUMNS)).withColumnRenamed("key", key)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    fine = (F.col("n_covered") <= F.col("n_words") * max_covered) & (
        (F.col("longest_repeat") < least_longest) | (F.col("longest_repeat") <= F.col("n_words") * max_longest)
    )
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
