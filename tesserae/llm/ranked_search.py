"""Ranked lexical search with a length-stratified index.

Documents whose length normaliser m is equal form a stratum. Rows are dealt by ranges of m and of a hash of their key,
so a stratum that holds many documents is spread over tasks, and a task sees its strata one after the other. In a
stratum the postings of a term stand by term frequency; what a frequency adds to a score depends on m alone, so it is
worked out once for each stratum and frequency. The highest frequency of each term bounds what any document of the
stratum can score. A query visits strata from the highest bound down and ends where the bound is below the lowest
score that it would still return.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tesserae.functions.storage import cut, discard
from tesserae.llm.blocks import cuts, texts
from tesserae.llm.decontaminate import blocks_of

#: A-Z become a-z; ASCII characters that are no letters or digits end a term.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
#: Postings that a task searches at once.
SEGMENT = 2_000_000


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    return text.translate(_LETTERS).split()


@dataclass
class Queries:
    """Queries as rows of term numbers; ``weights`` are repeats of a term in its query."""

    numbers: dict[bytes, int]
    begins: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[object, bytes]]) -> Queries:
        numbers: dict[bytes, int] = {}
        begins, ids, repeats = [0], [], []
        for _, text in items:
            for term, n in Counter(terms(text)).items():
                ids.append(numbers.setdefault(term, len(numbers)))
                repeats.append(n)
            begins.append(len(ids))
        return cls(numbers, np.array(begins, np.int64), np.array(ids, np.int64), np.array(repeats, np.int64))


def term_weight(documents: int, with_term: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * with_term + 1)))


def _sums(at: np.ndarray, values: np.ndarray, size: int, small: bool) -> np.ndarray:
    """Sums of integers by place; doubles are exact below 2^53."""
    if small:
        return np.bincount(at, values, size).astype(np.int64)
    found = np.zeros(size, np.int64)
    np.add.at(found, at, values)
    return found


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class Segment:
    """The strata of some documents; ``m`` is sorted."""

    def __init__(self, keys: np.ndarray, m: np.ndarray, sizes: np.ndarray, ids: np.ndarray, tfs: np.ndarray, n_terms: int):
        self.keys = keys
        stratum = np.cumsum(np.r_[0, m[1:] != m[:-1]])
        self.strata = int(stratum[-1]) + 1
        self.documents = np.bincount(stratum, minlength=self.strata)
        doc = np.repeat(np.arange(len(keys)), sizes)
        levels, level = np.unique(tfs, return_inverse=True)
        once, of = np.unique(stratum[doc] * len(levels) + level, return_inverse=True)  # a stratum and a frequency
        tf, every_m = levels[once % len(levels)], m[np.r_[True, m[1:] != m[:-1]]]
        impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * every_m[once // len(levels)])
        code = (stratum[doc] * n_terms + ids) * len(levels) + level
        order = np.argsort(code)
        code = code[order]
        self.doc, self.impact = doc[order], impacts[of[order]]
        group = code // len(levels)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        by_term = np.argsort(group[first] % n_terms, kind="stable")  # postings lists of a term, by stratum
        self.start = first[by_term]
        self.length = np.diff(np.r_[first, len(code)])[by_term]
        self.stratum = (group[first] // n_terms)[by_term]
        self.most = self.impact[self.start + self.length - 1]
        self.term_at = np.searchsorted((group[first] % n_terms)[by_term], np.arange(n_terms + 1))

    def search(self, ids: np.ndarray, weights: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (keys and scores, best first) with this segment's documents."""
        small = int(weights.sum()) * 1_000_000 < 1 << 53
        many = self.term_at[ids + 1] - self.term_at[ids]
        lists = _ranges(self.term_at[ids], many)
        weight = np.repeat(weights, many)
        bound = _sums(self.stratum[lists], weight * self.most[lists], self.strata, small)
        visits = np.argsort(-bound, kind="stable")
        place = np.empty(self.strata, np.int64)
        place[visits] = np.arange(self.strata)
        where, ends = place[self.stratum[lists]], np.cumsum(self.documents[visits])
        at, step = 0, 256
        while at < self.strata:
            least = int(best[1][-1]) if len(best[0]) == k else 1
            if bound[visits[at]] < least:  # equal scores go by key, so an equal bound is visited
                break
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step)) + 1
            chosen = (where >= at) & (where < to)
            postings = _ranges(self.start[lists[chosen]], self.length[lists[chosen]])
            added = np.repeat(weight[chosen], self.length[lists[chosen]]) * self.impact[postings]
            scores = _sums(self.doc[postings], added, len(self.keys), small)
            hit = np.flatnonzero(scores >= least)
            if len(hit) > 4 * k:  # ties with the k-th stay in
                hit = hit[scores[hit] >= np.partition(scores[hit], -k)[-k]]
            keys, found = np.r_[best[0], self.keys[hit]], np.r_[best[1], scores[hit]]
            first = np.lexsort((keys, -found))[:k]
            best = keys[first], found[first]
            at, step = to, step * 2
        return best


def _vectors(rows: DataFrame, queries) -> DataFrame:
    """``key, n, ids, tfs`` of every row with a term: its number of terms, and the queries' terms with frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = queries.value.numbers
        for part in cuts(batches, "text", 4 << 20):
            n, ids, tfs = [], [], []
            for text in texts(part.column("text")):
                words = terms(text)
                hits = [(numbers[t], c) for t, c in Counter(words).items() if t in numbers]
                n.append(len(words))
                ids.append(np.array([i for i, _ in hits], np.int32).tobytes())
                tfs.append(np.array([c for _, c in hits], np.int32).tobytes())
            found = pa.RecordBatch.from_arrays([part.column("key"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], names=["key", "n", "ids", "tfs"])
            yield found.filter(pa.array([x > 0 for x in n]))

    return rows.mapInArrow(run, "key long, n long, ids binary, tfs binary")


def _weights(vectors: DataFrame, documents: int, n_terms: int) -> np.ndarray:
    """Weight of each of the queries' terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_terms, np.int64)
        for batch in batches:
            seen += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.int32), minlength=n_terms)
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(seen[there])], names=["id", "df"])

    found = np.zeros(n_terms, np.int64)
    for row in vectors.select("ids").mapInArrow(count, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).collect():
        found[row["id"]] = row["df"]
    return np.array([term_weight(documents, df) for df in found.tolist()], np.int64)


def _ranked(vectors: DataFrame, queries, weights, k: int) -> DataFrame:
    """``item, key, score``: the ``k`` best documents of each query in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = queries.value, weights.value
        rows = [(asked.terms[a:b], asked.weights[a:b] * w[asked.terms[a:b]]) for a, b in zip(asked.begins, asked.begins[1:])]
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in rows]
        held: list[pa.RecordBatch] = []

        def search() -> None:
            table = pa.Table.from_batches(held)
            flat = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), np.int32).astype(np.int64)
            sizes = np.array([len(x) // 4 for x in table.column("ids").to_pylist()], np.int64)
            segment = Segment(table.column("key").to_numpy(), table.column("m").to_numpy(), sizes, flat("ids"), flat("tfs"), len(w))
            for i, (ids, own) in enumerate(rows):
                if len(ids):
                    best[i] = segment.search(ids, own, k, best[i])

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes // 8
            if size > SEGMENT:
                search()
                held, size = [], 0
        if held:
            search()
        item = np.repeat(np.arange(len(best)), [len(x[0]) for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), *(pa.array(np.concatenate([x[j] for x in best] or [np.zeros(0, np.int64)])) for j in (0, 1))], names=["item", "key", "score"])

    return vectors.mapInArrow(run, "item int, key long, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    query_text: str = "text",
    query_key: str = "item_id",
    k: int = 10,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """``query_key, rank, key, score``: the ``k`` highest-scoring rows of ``docs`` for each row of ``queries``.

    With N the rows that have a term, L all their terms, n the terms of a row, df the rows with a term and tf its
    occurrences in a row: a term weighs floor(1000 ln((2 N + 2) / (2 df + 1))), and a row scores the sum over the query's
    terms, repeats included, of weight * (10^9 tf div (1000 tf + 8 m)) with m = 25 + 75 n N div L, in whole numbers. Only
    scores above 0 count; equal ones go by key (an integer). The result is exact: no row is left out of the index.

    Queries go to the tasks in blocks of ``block_bytes`` of text, each with one pass over the texts that writes a row's
    terms of the block's queries. Null and empty texts have no terms; rows without a key count in N, L and df and are
    never returned; repeated rows are rows of their own and each can be returned; repeated queries each get their
    ranking, with the same key. Empty tables give no rows; other columns are left out.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    spark, kind = docs.sparkSession, queries.schema[query_key].dataType.simpleString()
    out = spark.createDataFrame([], f"`{query_key}` {kind}, rank int, `{key}` long, score long")
    for block in blocks_of(queries, query_text, query_key, block_bytes):
        asked = Queries.of(block)
        if not asked.numbers:
            continue
        shared = spark.sparkContext.broadcast(asked)
        vectors = cut(_vectors(rows, shared))
        total = vectors.agg(F.count("*").alias("rows"), F.sum("n").alias("terms")).first()
        if not total["rows"]:
            continue
        weights = spark.sparkContext.broadcast(_weights(vectors, total["rows"], len(asked.numbers)))
        m = F.expr(f"25L + (75L * n * {total['rows']}L) div {total['terms']}L")
        able = vectors.where("key IS NOT NULL AND octet_length(ids) > 0").select("key", m.alias("m"), "ids", "tfs")
        dealt = able.repartitionByRange("m", F.xxhash64("key")).sortWithinPartitions("m")
        found = cut(_ranked(dealt, shared, weights, k))
        discard([vectors])
        first = Window.partitionBy("item").orderBy(F.desc("score"), "key")
        top = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item int, name {kind}")
        out = out.unionByName(top.join(F.broadcast(names), "item").select(F.col("name").alias(query_key), "rank", F.col("key").alias(key), "score"))
    return out
