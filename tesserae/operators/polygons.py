"""Polygons against polygons: predicates, clipping, shared area, validity.

A ring is a closed array of points ``x, y``; a polygon is an array of rings, of which what an odd number of rings
contains is inside (so holes need no orientation).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tesserae.operators.geometry import area, contains

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def edges(ring: Column) -> Column:
    """Edges ``a, b`` of a ring; none of one point or none."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _side(a: Column, b: Column, c: Column) -> Column:
    """Over 0 if c lies to the left of a-b, 0 if on its line."""
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def _between(a: Column, b: Column, c: Column) -> Column:
    """Whether c lies in the box of a and b."""
    return c["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & c["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def edges_meet(p: Column, q: Column) -> Column:
    """Whether two edges share a point: cross, touch or overlap."""
    pa_, pb, qa, qb = p["a"], p["b"], q["a"], q["b"]
    d1, d2, d3, d4 = _side(pa_, pb, qa), _side(pa_, pb, qb), _side(qa, qb, pa_), _side(qa, qb, pb)
    on = ((d1 == 0) & _between(pa_, pb, qa)) | ((d2 == 0) & _between(pa_, pb, qb)) | ((d3 == 0) & _between(qa, qb, pa_)) | ((d4 == 0) & _between(qa, qb, pb))
    return ((F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)) | on


def inside(polygon: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in an odd number of a polygon's rings."""
    return F.aggregate(polygon, F.lit(0), lambda n, ring: n + contains(ring, x, y).cast("int")) % 2 == 1


def meet(a: Column, b: Column) -> Column:
    """Whether two polygons share a point, on their outlines or inside."""
    every = lambda polygon: F.flatten(F.transform(polygon, edges))
    first = lambda polygon: F.try_element_at(F.try_element_at(polygon, F.lit(1)), F.lit(1))
    touch = F.exists(every(a), lambda p: F.exists(every(b), lambda q: edges_meet(p, q)))
    return F.coalesce(touch | inside(b, first(a)["x"], first(a)["y"]) | inside(a, first(b)["x"], first(b)["y"]), F.lit(False))


def valid(ring: Column) -> Column:
    """Closed, with area, and nowhere in touch with itself; points that repeat at once are allowed.

    A sweep over the edges by their least x: an edge is compared with those whose x range it meets. Edges that follow
    each other may share their corner alone, so a spike is not valid; others may share no point.
    """
    lo = lambda p: F.least(p["a"]["x"], p["b"]["x"])
    moved = F.filter(edges(ring), lambda p: (p["a"]["x"] != p["b"]["x"]) | (p["a"]["y"] != p["b"]["y"]))
    tagged = F.transform(moved, lambda p, i: F.struct(lo(p).alias("lo"), F.greatest(p["a"]["x"], p["b"]["x"]).alias("hi"), i.cast("int").alias("i"), p["a"].alias("a"), p["b"].alias("b")))

    def back(p: Column, q: Column) -> Column:
        """Whether q, which begins where p ends, turns right round."""
        dot = (p["a"]["x"] - p["b"]["x"]) * (q["b"]["x"] - p["b"]["x"]) + (p["a"]["y"] - p["b"]["y"]) * (q["b"]["y"] - p["b"]["y"])
        return (_side(p["a"], p["b"], q["b"]) == 0) & (dot > 0)

    def clash(p: Column, q: Column, n: Column) -> Column:
        return F.when(q["i"] == (p["i"] + 1) % n, back(p, q)).when(p["i"] == (q["i"] + 1) % n, back(q, p)).otherwise(edges_meet(p, q))

    def simple(every: Column) -> Column:
        n = F.size(every)

        def step(state: Column, e: Column) -> Column:
            near = F.filter(state["open"], lambda o: o["hi"] >= e["lo"])
            clear = lambda found: F.struct(F.concat(found, F.array(e)).alias("open"), (state["fine"] & ~F.exists(found, lambda o: clash(o, e, n))).alias("fine"))
            return let(near, clear)

        start = F.struct(F.slice(every, 1, 0).alias("open"), F.lit(True).alias("fine"))
        return (n >= 3) & F.aggregate(F.array_sort(every), start, step, lambda state: state["fine"])

    first, last = F.try_element_at(ring, F.lit(1)), F.try_element_at(ring, F.lit(-1))
    closed = (first["x"] == last["x"]) & (first["y"] == last["y"])
    return F.coalesce((F.size(ring) >= 4) & closed & let(tagged, simple), F.lit(False))


def convex(ring: Column) -> Column:
    """Whether a valid ring turns one way only."""
    n = F.size(ring)
    turns = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.signum(_side(F.element_at(ring, i), F.element_at(ring, i + 1), F.element_at(ring, F.when(i + 2 <= n, i + 2).otherwise(2)))))
    return F.coalesce((n >= 4) & ~(F.array_contains(turns, 1.0) & F.array_contains(turns, -1.0)), F.lit(False))


def clipped(ring: Column, by: Column) -> Column:
    """The part of a ring inside a convex one, as a closed ring; it is cut at one edge of ``by`` after the other.

    Parts that lie apart stay joined by edges on the outline of ``by``, which have no area.
    """
    as_points = lambda r: F.transform(r, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    turn = F.signum(F.aggregate(edges(by), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])))
    turned = let(turn, lambda t: F.transform(edges(as_points(by)), lambda e: F.struct(e["a"].alias("a"), e["b"].alias("b"), t.alias("turn"))))
    none = F.array().cast(RING)

    def kept(x: Column) -> Column:
        p, q, t = x["p"], x["q"], x["dp"] / (x["dp"] - x["dq"])
        at = F.struct((p["x"] + (q["x"] - p["x"]) * t).alias("x"), (p["y"] + (q["y"] - p["y"]) * t).alias("y"))
        return F.when((x["dp"] >= 0) & (x["dq"] >= 0), F.array(q)).when(x["dp"] >= 0, F.array(at)).when(x["dq"] >= 0, F.array(at, q)).otherwise(none)

    def cut_at(poly: Column, e: Column) -> Column:
        depth = lambda p: _side(e["a"], e["b"], p) * e["turn"]
        deep = F.transform(edges(poly), lambda x: F.struct(x["a"].alias("p"), x["b"].alias("q"), depth(x["a"]).alias("dp"), depth(x["b"]).alias("dq")))
        return let(F.flatten(F.transform(deep, kept)), lambda points: F.concat(points, F.slice(points, 1, 1))).cast(RING)

    return F.aggregate(turned, as_points(ring).cast(RING), cut_at)


def clipped_area(ring: Column, by: Column) -> Column:
    """Area that a ring shares with a convex one."""
    return let(clipped(ring, by), lambda found: F.when(F.size(found) > 3, area(found)).otherwise(0.0))


def _all_edges(rings: list) -> np.ndarray:
    """``ax, ay, bx, by`` of all rings' edges that are not level."""
    parts = [np.array([(p["x"], p["y"]) for p in r], float) for r in rings or [] if r is not None and len(r) > 1]
    found = np.concatenate([np.c_[p[:-1], p[1:]] for p in parts]) if parts else np.zeros((0, 4))
    return found[found[:, 1] != found[:, 3]]


def _crossings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights at which edges of the one cross edges of the other."""
    out = []
    for k in range(0, len(a), 256):
        ax, ay, bx, by = (c[:, None] for c in a[k : k + 256].T)
        cx, cy, dx, dy = b.T
        den = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / den
            u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / den
        hit = (den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        out.append((ay + t * (by - ay))[hit])
    return np.concatenate(out) if out else np.zeros(0)


def shared_area(a: list, b: list) -> float:
    """Area that two polygons share: between neighbouring corners and crossings every piece is a trapezoid, whose area
    is its width half way up times its height."""
    ea, eb = _all_edges(a), _all_edges(b)
    if not len(ea) or not len(eb):
        return 0.0
    low, high = max(ea[:, [1, 3]].min(), eb[:, [1, 3]].min()), min(ea[:, [1, 3]].max(), eb[:, [1, 3]].max())
    heights = np.unique(np.clip(np.r_[ea[:, 1], ea[:, 3], eb[:, 1], eb[:, 3], _crossings(ea, eb)], low, high)) if low < high else np.zeros(0)
    total = 0.0
    for y0, y1 in zip(heights[:-1].tolist(), heights[1:].tolist()):
        y, places = (y0 + y1) / 2, []
        for e in (ea, eb):
            own = e[(np.minimum(e[:, 1], e[:, 3]) < y) & (np.maximum(e[:, 1], e[:, 3]) > y)]
            places.append(own[:, 0] + (y - own[:, 1]) * (own[:, 2] - own[:, 0]) / (own[:, 3] - own[:, 1]))
        x = np.concatenate(places)
        order = np.argsort(x, kind="stable")
        of_a = order < len(places[0])
        both = (np.cumsum(of_a)[:-1] % 2 == 1) & (np.cumsum(~of_a)[:-1] % 2 == 1)
        total += float(np.diff(x[order])[both].sum()) * (y1 - y0)
    return total


def with_shared_area(pairs: DataFrame, a: str, b: str, name: str = "shared_area") -> DataFrame:
    """``pairs`` with the area that the polygons of two columns share; they may be of any form and have holes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist())
            found = pa.array([None if x is None or y is None else shared_area(x, y) for x, y in both], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("_rest"), found], names=["_rest", "_area"])

    kind = f"array<{RING}>"
    rest = pairs.select(F.struct(*(F.col(f"`{c}`") for c in pairs.columns)).alias("_rest"), F.col(a).cast(kind).alias("_a"), F.col(b).cast(kind).alias("_b"))
    out = rest.mapInArrow(run, f"_rest {rest.schema['_rest'].dataType.simpleString()}, _area double")
    return out.select(*(F.col(f"_rest.`{c}`") for c in pairs.columns), F.col("_area").alias(name))


def with_bounds(df: DataFrame, ring: str = "ring") -> DataFrame:
    """``df`` with the box ``xmin, ymin, xmax, ymax`` of a ring."""
    at = lambda k: F.transform(ring, lambda p: p[k])
    return df.withColumns({"xmin": F.array_min(at("x")), "ymin": F.array_min(at("y")), "xmax": F.array_max(at("x")), "ymax": F.array_max(at("y"))})
