"""Polygons against polygons, scanlines, blocks of components, cells of several levels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import catalog, geometry, objects, polygons

RING = "array<struct<x:double,y:double>>"


def ring(*points):
    return [(float(x), float(y)) for x, y in (*points, points[0])]


def star(rnd, n, cx, cy, r):
    """A simple ring about a point."""
    return ring(*((cx + rnd.uniform(0.3, 1) * r * np.cos(t), cy + rnd.uniform(0.3, 1) * r * np.sin(t)) for t in np.linspace(0, 2 * np.pi, n, endpoint=False)))


def within(poly, x, y):
    odd = np.zeros(x.shape, bool)
    for r in poly:
        for (ax, ay), (bx, by) in zip(r, r[1:]):
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return odd


def test_shared_area_by_counting_points(spark):
    rnd = random.Random(3)
    y, x = np.mgrid[0:20:500j, 0:20:500j]
    rows = []
    for k in range(12):
        a = [star(rnd, rnd.randint(3, 12), 9, 9, 8)] + ([ring((8, 8), (10, 8), (10, 10), (8, 10))] if k % 2 else [])
        rows.append((k, a, [star(rnd, rnd.randint(3, 12), 11, 10, 8)]))
    df = polygons.with_shared_area(spark.createDataFrame(rows, f"k int, a array<{RING}>, b array<{RING}>"), "a", "b", "area")
    got = {r["k"]: (r["area"], r["m"]) for r in df.select("k", "area", polygons.meet(F.col("a"), F.col("b")).alias("m")).collect()}
    for k, a, b in rows:
        want = float((within(a, x, y) & within(b, x, y)).mean() * 400)
        assert abs(got[k][0] - want) < 0.02 * want + 0.5 and got[k][1] == (want > 0)
    assert polygons.shared_area([], [[]]) == 0.0


def test_convex_clip_equals_trapezoids(spark):
    rnd = random.Random(4)
    rows = [(k, star(rnd, rnd.randint(3, 9), 0, 0, 5), ring(*((rnd.uniform(1, 3) + 4 * np.cos(t), 4 * np.sin(t)) for t in np.linspace(0, (1 - 2 * (k % 2)) * 2 * np.pi, 5, endpoint=False)))) for k in range(12)]
    df = spark.createDataFrame(rows, f"k int, a {RING}, b {RING}").withColumn("convex", polygons.convex(F.col("b")))
    df = polygons.with_shared_area(df.withColumns({"pa": F.array("a"), "pb": F.array("b")}), "pa", "pb", "area")
    found = df.select("convex", "area", polygons.clipped_area(F.col("a"), F.col("b")).alias("clip")).collect()
    assert sum(r["convex"] for r in found) > 3
    assert all(abs(r["area"] - r["clip"]) < 1e-6 for r in found if r["convex"])


def test_validity(spark):
    cases = [
        (True, ring((0, 0), (4, 0), (4, 4), (0, 4))),
        (True, ring((0, 0), (4, 0), (4, 0), (4, 4), (0, 4))),
        (True, ring((0, 0), (4, 0), (2, 1), (0, 4))),
        (False, ring((0, 0), (4, 4), (4, 0), (0, 4))),
        (False, ring((0, 0), (4, 0), (4, 4), (2, 4), (2, 6), (2, 4), (0, 4))),
        (False, ring((0, 0), (2, 0), (4, 0), (4, 4), (2, 0), (0, 4))),
        (False, ring((0, 0), (4, 0), (2, 0))),
        (False, ring((0, 0), (0, 0), (0, 0))),
        (False, ring((0, 0), (4, 0), (4, 4), (2, 4), (2, 0), (1, 0), (0, 4))),
        (False, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]),
        (False, None),
        (False, []),
    ]
    df = spark.createDataFrame([(k, r) for k, (_, r) in enumerate(cases)], f"k int, r {RING}")
    got = {r["k"]: r["v"] for r in df.select("k", polygons.valid(F.col("r")).alias("v")).collect()}
    assert [got[k] for k in range(len(cases))] == [v for v, _ in cases]


def test_scanlines_against_every_cell(spark):
    rnd = random.Random(5)
    rows = [(k % 3, [star(rnd, 9, 10, 10, 9), star(rnd, 5, 10, 10, 3)]) for k in range(6)] + [(0, [ring((1, 1), (1, 5), (5, 5))]), (1, [])]
    cells = [(t, y, x, True, 2) for t in range(3) for y in range(21) for x in range(21)]
    labels = spark.createDataFrame(rows, f"tile_id int, rings array<{RING}>")
    got = geometry.rasterise(spark.createDataFrame(cells, "tile_id int, y int, x int, e boolean, q int"), labels, "e", "q").collect()
    assert len(got) == len(cells)
    for t in range(3):
        y, x = np.mgrid[0:21, 0:21] + 0.5
        want = np.any([within(r, x, y) for k, r in rows if k == t], axis=0)
        assert {(r["y"], r["x"]) for r in got if r["tile_id"] == t and r["label"] == 1} == set(zip(*map(list, np.nonzero(want))))
    runs = geometry.polygon_runs(spark.createDataFrame([(1, [ring((0, 0), (10_000, 0), (10_000, 3), (0, 3))])], f"tile_id int, rings array<{RING}>")).collect()
    assert [(r["y"], r["x0"], r["x1"]) for r in sorted(runs)] == [(y, 0, 10_000) for y in range(3)]


@pytest.mark.parametrize("neighbours", [4, 8])
def test_components_over_seams(spark, neighbours):
    """Blocks of any size give the labels of a walk over all cells."""
    rnd = random.Random(6)
    on = {(f"t{t}", y, x) for t, d in ((0, 0.35), (1, 0.6)) for y in range(-4, 22) for x in range(-3, 30) if rnd.random() < d}
    want, count = {}, {}
    for cell in sorted(on):
        if cell not in want:
            count[cell[0]] = count.get(cell[0], 0) + 1
            want[cell], todo = count[cell[0]], [cell]
            while todo:
                t, y, x = todo.pop()
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        near = (t, y + dy, x + dx)
                        if near in on and near not in want and (neighbours == 8 or not (dy and dx)):
                            want[near] = want[cell]
                            todo.append(near)
    df = spark.createDataFrame([(*c, True) for c in on], "tile_id string, y int, x int, m boolean")
    for block in (5, 256):
        assert {(r["tile_id"], r["y"], r["x"]): r["region_id"] for r in objects.label(df, "m", neighbours, block).collect()} == want


def test_boxes_of_all_sizes(spark):
    rnd = random.Random(7)

    def boxes(n):
        out = []
        for k in range(n):
            x, y, w, h = rnd.uniform(-900, 900), rnd.uniform(-900, 900), *(rnd.choice([0, 5, 100, 130, 900]) for _ in range(2))
            out.append((k, x, y, x + w, y + h))
        return [*out, (n, -100_000.0, -100_000.0, 100_000.0, 100_000.0), (n + 1, 0.0, 0.0, 100.0, 100.0), (n + 2, None, 0.0, 1.0, 1.0)]

    a, b = boxes(60), boxes(70)
    frame = lambda rows: spark.createDataFrame(rows, "id int, xmin double, ymin double, xmax double, ymax double")
    meets = lambda p, q: None not in (*p, *q) and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]
    got = [(r["id"], r["r_id"]) for r in catalog.intersecting(frame(a), frame(b)).collect()]
    assert sorted(got) == sorted((p[0], q[0]) for p in a for q in b if meets(p, q))
    assert catalog.intersecting(frame(a).limit(0), frame(b)).count() == 0
    with pytest.raises(ValueError):
        catalog.chosen_footprints(frame(a), frame(b).where("id > 9999"), "id")


def test_overlaps_compare_equal_boxes_once(spark, monkeypatch):
    rnd = random.Random(9)
    kinds = [(x, y, x + rnd.choice([0, 10, 250]), y + rnd.choice([0, 20, 90])) for x, y in ((rnd.randrange(300), rnd.randrange(300)) for _ in range(9))]
    rows = lambda n: [(k if k % 7 else None, *kinds[0 if k < n / 2 else rnd.randrange(9)]) for k in range(n)] + [(n, None, 0, 1, 1)]
    a, b = rows(60), rows(90)
    frame = lambda rows: spark.createDataFrame(rows, "id long, xmin int, ymin int, xmax int, ymax int")
    side = lambda p, q, i: min(p[i + 2], q[i + 2]) - max(p[i], q[i])
    both = [(p, q, side(p, q, 1), side(p, q, 2)) for p in a for q in b if None not in (*p[1:], *q[1:])]
    given, whole = [], catalog.intersecting
    monkeypatch.setattr(catalog, "intersecting", lambda *tables: given.extend(tables) or whole(*tables))
    monkeypatch.setattr(catalog, "BLOCK", 16)
    key = lambda r: tuple((v is None, v or 0) for v in r)
    found = catalog.overlaps(frame(a), frame(b))
    assert found.columns == ["id", "r_id", "area"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(((p[0], q[0], w * h) for p, q, w, h in both if w >= 0 and h >= 0), key=key)
    assert [df.where("xmin IS NOT NULL").count() <= len(set(kinds)) for df in given] == [True, True]


def test_overlaps_make_rows_by_tiles_in_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    """Two hot boxes: no pair of blocks is made in one step of generated code, and tasks grow with the rows to be made."""
    monkeypatch.setattr(catalog, "TASK_ROWS", 200, raising=False)
    monkeypatch.setattr(catalog, "BLOCK", 16)
    monkeypatch.setattr(catalog, "TILE", (3, 5), raising=False)
    frame = lambda n, x: spark.createDataFrame([(k, str(k) if k % 5 else None, x, 0, x + 10, 10) for k in range(n)], "id long, name string, xmin int, ymin int, xmax int, ymax int")
    found = catalog.overlaps(frame(50, 0), frame(70, 4)).withColumn("task", F.spark_partition_id())
    rows = found.collect()
    name = lambda k: str(k) if k % 5 else None
    assert sorted(tuple(r)[:-1] for r in rows if r["name"] and r["r_name"]) == sorted((p, name(p), q, name(q), 60) for p in range(50) for q in range(70) if name(p) and name(q))
    assert sorted((r["id"], r["r_id"]) for r in rows) == [(p, q) for p in range(50) for q in range(70)]
    assert len({r["task"] for r in rows}) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    steps = [line.lstrip(" +-:") for line in plan.splitlines() if "Generate explode(transform(" in line]
    assert len(steps) == 2 and not any(line.startswith("*") for line in steps), plan
    assert catalog.overlaps(frame(50, 0), frame(70, 400)).count() == 0


def test_rings_over_seams_and_nested_holes(spark):
    """Outlines put together from blocks are those of one block; holes name the ring about them."""
    rnd = random.Random(8)
    art = {
        "a": ["#########", "#.......#", "#.#####.#", "#.#...#.#", "#.#.#.#.#", "#.#...#.#", "#.#####.#", "#.......#", "#########"],
        "b": ["###...", "#.#...", "###...", "...###", "...#.#", "...###"],  # two blocks with a hole each, joined at a corner
        "c": ["".join(rnd.choice("##.") for _ in range(14)) for _ in range(11)],
    }
    cells = [(t, y, x, True) for t, rows in art.items() for y, row in enumerate(rows) for x, c in enumerate(row) if c == "#"]
    labels = objects.label(spark.createDataFrame(cells, "tile_id string, y int, x int, m boolean"), "m")
    plain = lambda block: sorted((r["tile_id"], r["region_id"], r["ring_id"], tuple((p["x"], p["y"]) for p in r["ring"]), r["hole"], r["outer"]) for r in objects.polygons(labels, block).collect())
    want = plain(256)
    assert plain(4) == want
    signed = lambda ring: sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:])) / 2
    count = {}
    for r in labels.collect():
        count[r["tile_id"], r["region_id"]] = count.get((r["tile_id"], r["region_id"]), 0) + 1
    for key, n in count.items():
        assert sum(signed(r[3]) for r in want if r[:2] == key) == n
    assert all((signed(r[3]) < 0) == r[4] and (r[2] == r[5]) == (not r[4]) for r in want)
    frames = [r for r in want if r[0] == "a"]
    assert [(r[1], r[4]) for r in frames] == [(1, False), (1, True), (2, False), (2, True), (3, False)]
    pair = {r[2]: r for r in want if r[0] == "b"}
    holes = [r for r in pair.values() if r[4]]
    assert len(pair) == 4 and [pair[h[5]][3][0] for h in holes] == [(0, 0), (3, 3)]


def test_erosion_by_instance(spark):
    from tesserae.operators import metrics

    rnd = random.Random(9)
    cells = {(y, x): 1 + (x > 12) for y in range(20) for x in range(25) if rnd.random() < 0.97}
    df = spark.createDataFrame([(0, r, y, x) for (y, x), r in cells.items()], "tile_id int, region_id int, y int, x int")
    for steps in (1, 2):
        inner = {(y, x) for (y, x), r in cells.items() if all(cells.get((y + a, x + b)) == r for a in range(-steps, steps + 1) for b in range(-steps, steps + 1))}
        assert {(r["y"], r["x"]) for r in metrics.eroded_instances(df, steps).collect()} == inner
