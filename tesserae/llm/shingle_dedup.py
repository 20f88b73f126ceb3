"""Near-duplicates by shingle similarity: SimHash links first, then an exact join for the pairs that they miss.

Fingerprints within a few bits are linked by the vantage-point trees of ``simhash`` and checked by the sets of
shingles. A pair of Jaccard similarity 0.8 differs in about 10 of 64 bits, too many for any tree over them, so an exact
join finds the others: two sets of Jaccard t or more share an element among the first n - ceil(t n) + 1 of each, in
any order of all elements that both follow. Here shingles that a bounded sample finds frequent come last, by their
count, and the rest go by hash, so that what many texts have in common brings few of them together; the sample bears
on speed alone. Texts that meet in a shingle are first compared with one of them, so that a large group of copies is
joined without all its pairs; only pairs that meet and are not yet joined are compared after that. No pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tesserae.functions.graph import components
from tesserae.functions.storage import cut, discard
from tesserae.llm.blocks import cuts, texts
from tesserae.llm.simhash import link_edges, majority

SEED = 42
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Shingles that the sample finds frequent, at most; others go by hash.
FREQUENT = 50_000


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes, words_per_shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text of fewer words, or of none, is one shingle."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w, SEED) for w in words], np.uint64)
    size = min(len(h), words_per_shingle)
    total = np.full(max(1, len(h) - size + 1), size, np.uint64)
    for i in range(size):
        total = total * _MIX + h[i : i + len(total)]
    return np.unique(_mixed(total))


def node_of(found: np.ndarray) -> int:
    """A hash of a whole set; equal sets are one node."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).astype(np.int64))


def prefix(found: np.ndarray, hashes: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first elements, of which any set of ``similarity`` shares one; ``hashes`` (sorted) are the frequent ones."""
    rank = np.zeros(len(found), np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        rank = np.where(hashes[at] == found, counts[at], 0)
    return found[np.argsort(rank, kind="stable")][: len(found) - ceil(len(found) * similarity - 1e-9) + 1]


def _frequent(docs: DataFrame, words_per_shingle: int, sample_rows: int, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in ``least`` or more texts of a sample of about ``sample_rows`` rows, and their counts."""
    step = max(1, docs.count() // sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cuts(batches, "text", 4 << 20):
            found = np.concatenate([shingles(t, words_per_shingle) for t in texts(block.column("text"))])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["h"])

    some = docs.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).select("text").mapInArrow(run, "h long")
    rows = some.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    hashes = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["n"] for r in rows], np.int64)[order]


def _similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, similarity: float, words_per_shingle: int) -> DataFrame:
    """The pairs ``u, v`` whose sets have the similarity, from the texts themselves."""
    wanted = cut(pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct())
    chosen = nodes.join(wanted, "node", "left_semi").select(F.col("least").alias("key"), "node")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cuts(batches, "text", 1 << 20):
            found = [shingles(t, words_per_shingle).view(np.int64) for t in texts(block.column("text"))]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(np.concatenate(found), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in found], pa.int64()), lists], names=["node", "data"])

    given = docs.join(chosen.select("key").distinct(), "key", "left_semi").select("text").mapInArrow(sets, "node long, data array<long>")
    data = cut(given.join(wanted, "node", "left_semi").dropDuplicates(["node"]))
    both = pairs.join(data.select(F.col("node").alias("u"), F.col("data").alias("a")), "u").join(data.select(F.col("node").alias("v"), F.col("data").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    found = cut(both.where(shared >= similarity * (F.size("a") + F.size("b") - shared) - 1e-9).select("u", "v").distinct())
    discard([data])
    return found


def _enough(similarity: float):
    """Whether two sets of ``size`` and ``other_size`` that share ``n`` of their first elements can be similar.

    What they share beyond those lies past the first elements of the one whose first elements end earlier.
    """
    a, b = F.col("size"), F.col("other_size")
    rest = F.greatest(F.ceil(a * similarity - 1e-9), F.ceil(b * similarity - 1e-9)) - 1
    return F.col("n") + rest >= (a + b) * (similarity / (1 + similarity)) - 1e-6


def _near_in_size(similarity: float):
    return F.least("size", "other_size") >= F.greatest("size", "other_size") * similarity - 1e-9


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs that are not joined yet."""
    of = lambda name: groups.select(F.col("node").alias(name), F.col("component").alias(f"{name}_group"))
    both = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left")
    return both.where(F.col("u_group").isNull() | F.col("v_group").isNull() | (F.col("u_group") != F.col("v_group"))).select("u", "v")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = 0.8, words_per_shingle: int = 5, sample_rows: int = 10_000) -> DataFrame:
    """``key, component_id`` of every row with a key: the smallest key that links of Jaccard ``similarity`` reach.

    Words are split at ASCII white space and bytes A-Z lower-cased. Rows with equal sets are one node, however many
    there are; null and empty texts are equal to each other. Rows without a key are left out.
    """
    given = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("key IS NOT NULL")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(given, words_per_shingle, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = frequent.value
        for block in cuts(batches, "text", 4 << 20):
            found = [shingles(t, words_per_shingle) for t in texts(block.column("text"))]
            first = [prefix(s, hashes, counts, similarity).view(np.int64) for s in found]
            fps = np.array([majority(s) for s in found], np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, first)]), pa.int32()), pa.array(np.concatenate(first), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([node_of(s) for s in found], pa.int64()), pa.array(fps), pa.array([len(s) for s in found], pa.int32()), lists],
                names=["key", "node", "fp", "size", "first"],
            )

    wide = cut(given.mapInArrow(run, f"key {given.schema['key'].dataType.simpleString()}, node long, fp long, size int, first array<long>"))
    rows = cut(wide.select("key", "node"))
    nodes = cut(wide.groupBy("node").agg(F.min("key").alias("least"), F.min("fp").alias("fp")))
    # SimHash links: every node to the least of its fingerprint, and that one along the trees' edges
    by_fp = cut(nodes.groupBy("fp").agg(F.min("node").alias("lead")))
    tree = link_edges(by_fp.select("fp"))
    lead = lambda name: by_fp.select(F.col("fp").alias(name), F.col("lead").alias(f"{name}_lead"))
    along = tree.join(lead("u"), "u").join(lead("v"), "v").select(F.col("u_lead").alias("u"), F.col("v_lead").alias("v"))
    equal = nodes.join(by_fp, "fp").where("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    linked = _similar(cut(along.union(equal)), given, nodes, similarity, words_per_shingle)
    groups = cut(components(linked))
    single = wide.join(nodes.select("node", F.col("least").alias("key")), ["node", "key"], "left_semi").dropDuplicates(["node"])
    # one exchange serves both sides: the columns of the one are all used in the other
    dealt = single.select("node", "size", F.explode("first").alias("h")).repartition("h")
    shared = dealt.groupBy("h").agg(F.min("node").alias("lead"), F.max("node").alias("last"), F.max("size").alias("most")).where("lead <> last AND most > 0")
    meet = cut(dealt.join(shared.select("h", "lead", "most"), "h").where("most > 0").select("h", "lead", "node", "size"))
    discard([wide])
    sizes = meet.where("node = lead").select("h", F.col("size").alias("other_size"))
    # a pair counts only where one of the two leads; those that this leaves out come after
    stars = meet.where("node <> lead").join(sizes, "h").where(_near_in_size(similarity))
    stars = stars.groupBy(F.col("node").alias("u"), F.col("lead").alias("v"), "size", "other_size").agg(F.count("*").alias("n")).where(_enough(similarity))
    stars = cut(_apart(stars.select("u", "v"), groups))
    linked = linked.union(_similar(stars, given, nodes, similarity, words_per_shingle))
    groups = cut(components(linked))
    labelled = meet.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = labelled.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("h")
    left = cut(labelled.join(open_, "h", "left_semi").select("h", "node", "size", "component"))
    discard([meet])
    other = left.select("h", *(F.col(c).alias(f"other_{c}") for c in ("node", "size", "component")))
    pairs = left.join(other, "h").where((F.col("node") > F.col("other_node")) & (F.col("component") != F.col("other_component")) & _near_in_size(similarity))
    pairs = pairs.groupBy(F.col("node").alias("u"), F.col("other_node").alias("v"), "size", "other_size").agg(F.count("*").alias("n")).where(_enough(similarity))
    pairs = cut(pairs.select("u", "v").join(stars, ["u", "v"], "left_anti"))
    discard([left])
    groups = components(linked.union(_similar(pairs, given, nodes, similarity, words_per_shingle)))
    named = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(least, "component").select("node", "component_id")
    return rows.join(label, "node").select(F.col("key").alias(key), "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = 0.8, words_per_shingle: int = 5) -> DataFrame:
    """``docs`` without the rows whose group has a smaller key; rows without a key stay, as nothing names them."""
    found = near_duplicates(docs, text, key, similarity, words_per_shingle)
    gone = found.where(F.col(key) > F.col("component_id")).select(key).distinct()
    return docs.join(gone, key, "left_anti")
