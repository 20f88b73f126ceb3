"""Near-duplicates by bottom-k sketches of one hash function.

The k smallest hashes of a set are its sketch, and the k smallest of two sketches together are a sketch of the union.
Of two sets of similarity t each of those is in both with probability t, so the sketches share at least ``needed`` of
them but for one pair in 10^9 (``miss``); a sketch that is the whole set is exact. Inverted lists hold the retained
values that two sets and more have. A set goes to the lists of its rarest values, by exact counts, and only to so many
that any similar one has to meet it there; sets that have too few shared values at all go to none. In a list all are
first compared with one of them, which joins groups of copies without all their pairs; pairs that meet and are not
joined by then are compared after that, those of large lists once they meet in the lists of their whole sets, too.
Sketches of the union filter pairs, the whole sets confirm them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.graph import components
from tesserae.functions.storage import cut, discard
from tesserae.llm.blocks import cuts, texts
from tesserae.llm.shingle_dedup import shingles

#: Nodes of a list from which on they are listed anew by their whole sets.
LARGE = 100


def needed(k: int, percent: int, miss: float = 1e-9) -> int:
    """Values of a union's sketch that two sets of the similarity share at least, but with the probability ``miss``."""
    t, below, c = percent / 100, 0.0, 0
    while c < k:
        below += comb(k, c) * t**c * (1 - t) ** (k - c)
        if below > miss:
            break
        c += 1
    return c


def hashed(text: bytes, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of a text's shingles; none of a text without words."""
    return np.unique(shingles(text, words_per_shingle) >> np.uint64(1)).astype(np.int64) if text.strip() else np.zeros(0, np.int64)


def digest(found: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return xxhash.xxh3_128_digest(found.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], pa.int64()))


def sketches(rows: DataFrame, k: int, words_per_shingle: int) -> DataFrame:
    """``key, digest, n, sketch`` of rows ``key, text``: the set's digest and size, and its ``k`` smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cuts(batches, "text", 4 << 20):
            found = [hashed(t, words_per_shingle) for t in texts(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array([digest(s) for s in found], pa.binary()), pa.array([len(s) for s in found], pa.int64()), _lists([s[:k] for s in found])],
                names=["key", "digest", "n", "sketch"],
            )

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, digest binary, n long, sketch array<long>")


def _least_shared(n: Column, k: int, c: int, percent: int) -> tuple[Column, Column]:
    """Sketch values that a set of size ``n`` shares at least with a similar one, and with one that is not smaller."""
    any_, not_smaller = F.ceil(n * percent / 100), F.ceil(n * (2 * percent) / (100 + percent))
    alone = n * 100 <= percent * k  # no similar set is larger than its sketch
    return F.when(alone, any_).otherwise(F.least(any_, F.lit(c))), F.when(alone, not_smaller).otherwise(F.least(not_smaller, F.lit(c)))


def _memberships(nodes: DataFrame, k: int, c: int, percent: int) -> DataFrame:
    """``h, node, n, rest, least, small, own`` of the lists that a node goes to.

    ``rest``: shared values from this one on; ``small``: whether a set that is not smaller can be met first here;
    ``own``: values that no other node has.
    """
    values = nodes.select("node", "n", F.explode("sketch").alias("h"))
    counts = cut(values.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"))
    held = values.join(counts, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("values"))
    least, least_small = _least_shared(F.col("n"), k, c, percent)
    able = held.withColumns({"least": least, "least_small": least_small, "m": F.size("values")}).where("m >= least")
    listed = able.select("node", "n", "least", "least_small", "m", F.posexplode(F.slice("values", F.lit(1), (F.col("m") - F.col("least") + 1).cast("int"))).alias("place", "v"))
    rest = F.col("m") - F.col("place")
    return cut(listed.select(F.col("v.h").alias("h"), "node", "n", rest.alias("rest"), "least", (rest >= F.col("least_small")).alias("small"), (F.least("n", F.lit(k)) - F.col("m")).alias("own")))


def _possible(k: int, percent: int) -> Column:
    """Whether two sets that meet in a list first can be similar, by their sizes and the shared values left."""
    n, o = F.col("n"), F.col("other_n")
    whole = F.greatest(n, o) <= k
    least = F.greatest("least", "other_least", F.when(whole, F.ceil((n + o) * percent / (100 + percent))).otherwise(F.lit(0)))
    role = ((n > o) | F.col("small")) & ((n < o) | F.col("other_small"))
    return role & (F.least(n, o) * 100 >= F.greatest(n, o) * percent) & (F.least("rest", "other_rest") >= least)


def _other(lists: DataFrame, *more: str) -> DataFrame:
    return lists.select("h", F.col("node").alias("v"), *(F.col(x).alias(f"other_{x}") for x in ("n", "rest", "least", "small", *more)))


def _sets(docs: DataFrame, nodes: DataFrame, words_per_shingle: int) -> DataFrame:
    """``node, data``: the whole sets of these nodes, from the texts of their least keys."""
    wanted = cut(nodes.select("node", "digest", F.col("least").alias("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cuts(batches, "text", 1 << 20):
            found = [hashed(t, words_per_shingle) for t in texts(part.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in found], pa.binary()), _lists(found)], names=["digest", "data"])

    given = docs.join(wanted.select("key").distinct(), "key", "left_semi").select("text").mapInArrow(run, "digest binary, data array<long>")
    return cut(given.join(wanted.select("digest", "node"), "digest").select("node", "data").dropDuplicates(["node"]))


def _similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, c: int, percent: int, words_per_shingle: int) -> DataFrame:
    """The pairs ``u, v`` whose sets are similar: filtered by the sketch of the union, confirmed by the sets."""
    of = lambda name: nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
    both = pairs.join(of("u"), "u").join(of("v"), "v").withColumn("shared", F.array_intersect("s_u", "s_v"))
    total = F.col("n_u") + F.col("n_v")
    whole = F.greatest("n_u", "n_v") <= k  # then the sketches are the sets
    in_union = F.size(F.array_intersect("shared", F.slice(F.sort_array(F.array_union("s_u", "s_v")), 1, k)))
    exact = F.size("shared") * 100 >= (total - F.size("shared")) * percent
    judged = both.select("u", "v", whole.alias("whole"), F.when(whole, exact).otherwise(in_union >= c).alias("may")).where("may")
    judged = cut(judged.select("u", "v", "whole"))
    open_ = judged.where("NOT whole").select("u", "v")
    ends = open_.select(F.col("u").alias("node")).union(open_.select(F.col("v").alias("node"))).distinct()
    data = _sets(docs, nodes.join(ends, "node", "left_semi"), words_per_shingle)
    full = open_.join(data.select(F.col("node").alias("u"), F.col("data").alias("a")), "u").join(data.select(F.col("node").alias("v"), F.col("data").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    confirmed = full.where(shared * 100 >= (F.size("a") + F.size("b") - shared) * percent).select("u", "v")
    found = cut(judged.where("whole").select("u", "v").union(confirmed))
    discard([data])
    return found


def _apart(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Lists with nodes of several components, with each node's ``component``, and their sizes ``many``."""
    labelled = lists.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = labelled.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("many")).where("lo <> hi").select("h", "many")
    return cut(labelled.join(open_, "h"))


def _met(lists: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs ``u, v`` of different components that meet in a list and can be similar."""
    both = lists.join(_other(lists, "component"), "h").where((F.col("node") > F.col("v")) & (F.col("component") != F.col("other_component")) & _possible(k, percent))
    return both.select(F.col("node").alias("u"), "v").distinct()


def _stars(lists: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs ``u, v`` of nodes and the lead of a list that they are in: the node with the fewest values of its own, as
    copies lie about what they were copied from."""
    leads = lists.groupBy("h").agg(F.min(F.struct("own", "node", "n", "rest", "least", "small")).alias("lead"), F.count("*").alias("many")).where("many > 1").select("h", "lead.*")
    met = lists.join(_other(leads), "h").where((F.col("node") != F.col("v")) & _possible(k, percent))
    return cut(met.select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct())


def _links(nodes: DataFrame, docs: DataFrame, k: int, c: int, percent: int, words_per_shingle: int) -> DataFrame:
    """Pairs ``u, v`` of similar nodes that connect whatever similar nodes connect."""
    judge = lambda pairs: _similar(pairs, docs, nodes, k, c, percent, words_per_shingle)
    lists = _memberships(nodes, k, c, percent)
    stars = _stars(lists, k, percent)
    linked = judge(stars)
    groups = cut(components(linked))
    left = _apart(lists, groups)
    discard([lists])
    few = cut(_met(left.where(F.col("many") <= LARGE), k, percent))
    # what meets in large lists is listed anew by whole sets, which leave nothing to chance and so fewer pairs
    large = cut(left.where(F.col("many") > LARGE).select("node").distinct())
    discard([left])
    whole = _sets(docs, nodes.join(large, "node", "left_semi"), words_per_shingle).select("node", F.size("data").cast("long").alias("n"), F.col("data").alias("sketch"))
    most = (1 << 31) - 1
    anew = _memberships(whole, most, c, percent)
    again = _stars(_apart(anew, groups).drop("component", "many"), most, percent)
    linked = linked.union(judge(cut(few.union(again).distinct().join(stars, ["u", "v"], "left_anti"))))
    groups = cut(components(linked))
    pairs = _met(_apart(anew, groups), most, percent)
    for done in (stars, few, again):
        pairs = pairs.join(done, ["u", "v"], "left_anti")
    found = linked.union(judge(cut(pairs)))
    discard([anew])
    return found


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 80, words_per_shingle: int = 4, k: int = 128) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row.

    Words stand between ASCII white space, A-Z are lower-cased; a row's set are its distinct shingles of
    ``words_per_shingle`` words, or of all words if there are fewer. Rows are linked if 100 times the shingles they share
    is at least ``percent`` times those of both; ``component_id`` is the smallest key that links reach, and the row that
    has it is kept. Rows with equal sets are compared once, however many there are. Null and empty texts have no
    shingles and are linked with nothing. Rows without a key have no component and stay. Rows with one key and
    different texts are rows of their own; repeated rows are all kept if one is. Other columns are left out.
    """
    c = needed(k, percent)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    wide = cut(sketches(rows, k, words_per_shingle))
    own = wide.where("n > 0 AND key IS NOT NULL").groupBy("digest").agg(F.min("key").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = cut(own.withColumn("node", F.monotonically_increasing_id()))  # fixed once it is written
    groups = cut(components(_links(nodes, rows, k, c, percent, words_per_shingle)))
    named = nodes.select("digest", "node", "least").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(least, "component").select("digest", "component_id")
    found = wide.select("key", "digest", "n").join(label, "digest", "left")
    component = F.when(F.col("key").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
