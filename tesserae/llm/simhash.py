"""SimHash near-duplicates: fingerprints, and vantage-point trees that find all pairs within a few bits.

Two fingerprints that differ in at most ``radius`` bits differ in at most ``radius // bands`` bits in one of ``bands``
disjoint bit bands. Each band has a vantage-point tree over the Hamming distance within the band. A node sends a
fingerprint to its near or far side by the distance to the vantage point; by the triangle bound a partner can be on
the other side only if the distance is that close to the border, and such fingerprints go to both sides. Leaves are
shards; inside a shard exact distances over all 64 bits are taken, again pruned by the triangle bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tesserae.functions.graph import components
from tesserae.functions.storage import cut
from tesserae.llm.blocks import cuts, texts
from tesserae.llm.joins import spread

SEED = 42
BITS = 64


def majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        set_bits += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, words_per_shingle: int = 4) -> int:
    """The majority of the shingles' hashes; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), SEED) for s in zip(*(words[i:] for i in range(words_per_shingle)))], "<u8")
    return majority(hashes)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words_per_shingle: int = 4) -> DataFrame:
    """``key, fp`` (64 bits as a long) of every row. Bytes A-Z are lower-cased; null counts as empty."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cuts(batches, "text", 4 << 20):
            found = np.array([fingerprint(t, words_per_shingle) for t in texts(block.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column("key"), pa.array(found.view(np.int64))], names=["key", "fp"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


class VantageTrees:
    """One vantage-point tree for each bit band, grown from a bounded sample."""

    def __init__(self, sample: np.ndarray, there: int, radius: int, bands: int = 3, shard: int = 2048, seed: int = 5):
        self.reach = radius // bands
        rng = np.random.default_rng(seed)
        edges = np.linspace(0, BITS, bands + 1).astype(int)
        self.masks = [np.uint64(sum(1 << b for b in range(lo, hi))) for lo, hi in zip(edges, edges[1:])]
        self.leaves = 0
        scale = max(1.0, there / max(1, len(sample)))
        self.roots = [self._grow(sample & mask, mask, scale, shard, rng, 0) for mask in self.masks]

    def _grow(self, points: np.ndarray, mask: np.uint64, scale: float, shard: int, rng: np.random.Generator, depth: int):
        if len(points) * scale > shard and len(points) >= 8 and depth < 40:
            best = None
            for vantage in points[rng.integers(0, len(points), 6)]:
                d = np.bitwise_count(points ^ vantage).astype(np.int64)
                by = np.cumsum(np.bincount(d, minlength=BITS + 1))
                for border in range(BITS):
                    near, far = by[min(BITS, border + self.reach)], len(points) - by[border]
                    cost = max(near, far) + 0.5 * (near + far)
                    if far and near < len(points) and (best is None or cost < best[0]):
                        best = (cost, vantage, border)
            if best and best[0] < 1.35 * len(points):
                _, vantage, border = best
                d = np.bitwise_count(points ^ vantage).astype(np.int64)
                return (
                    vantage,
                    border,
                    self._grow(points[d <= border + self.reach], mask, scale, shard, rng, depth + 1),
                    self._grow(points[d > border], mask, scale, shard, rng, depth + 1),
                )
        self.leaves += 1
        return self.leaves - 1

    def shards(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every shard of every point, as (index of the point, shard)."""
        index, found = [], []
        for root, mask in zip(self.roots, self.masks):
            todo = [(root, np.arange(len(points)))]
            while todo:
                node, at = todo.pop()
                if not len(at):
                    continue
                if isinstance(node, int):
                    index.append(at)
                    found.append(np.full(len(at), node))
                    continue
                vantage, border, near, far = node
                d = np.bitwise_count((points[at] & mask) ^ vantage)
                todo += [(near, at[d <= border + self.reach]), (far, at[d > border])]
        return (np.concatenate(index), np.concatenate(found)) if index else (np.zeros(0, int), np.zeros(0, int))


def linked_roots(points: np.ndarray, radius: int, rows: int = 256) -> np.ndarray:
    """For each distinct fingerprint of a shard, the index of its group's root under links within ``radius`` bits.

    Sorted by the distance to one of them, only those whose distances differ by at most ``radius`` can be linked.
    """
    n = len(points)
    parent = np.arange(n)
    if n < 2:
        return parent
    d = np.bitwise_count(points ^ points[0]).astype(np.int64)
    order = np.argsort(d, kind="stable")
    p, d = points[order], d[order]
    for at in range(0, n, rows):
        to = min(at + rows, n)
        end = int(np.searchsorted(d, d[to - 1] + radius, side="right"))
        r, c = np.nonzero(np.bitwise_count(p[at:to, None] ^ p[None, at:end]) <= radius)
        keep = c > r
        a, b = r[keep] + at, c[keep] + at
        while len(a):
            x, y = parent[a], parent[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    out = np.empty(n, np.int64)
    out[order] = order[parent]
    return out


def link_edges(fps: DataFrame, radius: int = 4, shard: int = 2048, sample_rows: int = 20_000, most: int = 1 << 15) -> DataFrame:
    """Edges ``u, v`` within ``radius`` bits that join the fingerprints of ``fps`` (distinct, column ``fp``) as all links do.

    A shard gives each linked fingerprint one edge to a root, never all pairs. The trees come from a sample of at most
    ``sample_rows`` fingerprints, every fingerprint is routed, so the sample bears on speed alone. A shard of more than
    ``most`` fingerprints is split by its data: of ``radius`` + 1 parts of the bits, linked ones have one in common.
    """
    there = fps.count()
    few = fps.orderBy(F.xxhash64("fp")).limit(sample_rows).collect()
    trees = VantageTrees(np.array([r["fp"] for r in few], np.int64).view(np.uint64), there, radius, shard=shard)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            index, found = trees.shards(points.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(points[index])], names=["shard", "fp"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        points = np.unique(rows["fp"].to_numpy(np.int64)).view(np.uint64)
        root = linked_roots(points, radius)
        linked = root != np.arange(len(points))
        return pd.DataFrame({"u": points[linked].view(np.int64), "v": points[root[linked]].view(np.int64)})

    routed = cut(fps.select("fp").mapInArrow(route, "shard long, fp long"))
    large = routed.groupBy("shard").count().where(F.col("count") > most).select("shard", F.lit(True).alias("large"))
    width = BITS // (radius + 1) + 1
    bits = lambda i: F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << width) - 1)
    parts = F.when(F.col("large"), F.array(*(bits(i) * (radius + 1) + i for i in range(radius + 1)))).otherwise(F.array(F.lit(-1).cast("long")))
    dealt = spread(routed, large, ["shard"], "left").select("shard", F.explode(parts).alias("part"), "fp")
    return dealt.groupBy("shard", "part").applyInPandas(join, "u long, v long")


def link_groups(fps: DataFrame, radius: int = 4, **options) -> DataFrame:
    """``fp, group_fp`` for every fingerprint of ``fps`` (distinct, column ``fp``) that has a link."""
    return components(link_edges(fps, radius, **options)).select(F.col("node").alias("fp"), F.col("component").alias("group_fp"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 4, words_per_shingle: int = 4) -> DataFrame:
    """``key, fp, component_id`` of every row: the smallest key that links of ``radius`` bits or fewer reach.

    Equal fingerprints are one node, however many rows share it. Null and empty texts have fingerprint 0 and are
    linked like any other. Rows with a null key keep a row; the smallest key ignores nulls and is null only if all
    are. An empty table gives an empty result. Other columns are left out.
    """
    rows = cut(fingerprints(docs, text, key, words_per_shingle).select(F.col(key).alias("key"), "fp"))
    nodes = cut(rows.groupBy("fp").agg(F.min("key").alias("least")))
    groups = link_groups(nodes, radius)
    named = nodes.join(groups, "fp", "left").withColumn("group_fp", F.coalesce("group_fp", "fp"))
    least = named.groupBy("group_fp").agg(F.min("least").alias("component_id"))
    label = named.join(least, "group_fp").select("fp", "component_id")
    return rows.join(label, "fp").select(F.col("key").alias(key), "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 4, words_per_shingle: int = 4) -> DataFrame:
    """``docs`` without the rows whose group has a smaller key; rows without a key stay, as nothing names them."""
    found = near_duplicates(docs, text, key, radius, words_per_shingle)
    gone = found.where(F.col(key) > F.col("component_id")).select(key).distinct()
    return docs.join(gone, key, "left_anti")
