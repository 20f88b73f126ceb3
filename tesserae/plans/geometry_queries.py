"""Queries over grids, rings and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.functions.storage import cut
from tesserae.operators import catalog, geometry, polygons
from tesserae.plans.base import CELL, DECODED, decoded, pixels, query, r6
from tesserae.sources.adapters import cte, load, table

_P = cte("pixels")
_F = cte("footprints")


@query(f"{_P}, a AS (SELECT tile_id, y, x, red_dn FROM pixels WHERE x % 4 <> 1), b AS (SELECT tile_id, y, x, s2_scl FROM pixels WHERE y % 5 <> 2) SELECT a.tile_id, a.y, a.x, red_dn, s2_scl FROM a JOIN b ON a.tile_id = b.tile_id AND a.y = b.y AND a.x = b.x")
def f1_merge_on_grid(spark, sf_dir):
    p = pixels(spark, sf_dir)
    a = p.where("x % 4 <> 1").select(*CELL, "red_dn")
    return a.join(p.where("y % 5 <> 2").select(*CELL, "s2_scl"), list(CELL))


@query(f"{DECODED}, t AS (SELECT tile_id, y, x, dem FROM decoded WHERE x < 40), c AS (SELECT tile_id, y, x, s2_scl AS trend FROM decoded WHERE y < 20) SELECT d.tile_id, d.y, d.x, round(d.red, 6) AS red, t.dem, coalesce(c.trend, 0) AS trend FROM decoded d LEFT JOIN t ON t.tile_id = d.tile_id AND t.y = d.y AND t.x = d.x LEFT JOIN c ON c.tile_id = d.tile_id AND c.y = d.y AND c.x = d.x")
def f2_assemble_features(spark, sf_dir):
    d = decoded(spark, sf_dir)
    tiles = d.select("tile_id").distinct()
    grid = tiles.select("tile_id", F.lit("EPSG:32632").alias("crs"), (F.col("tile_id") * 500.0).alias("x0"), F.lit(4.5e6).alias("y0"), F.lit(10.0).alias("res_x"), F.lit(-10.0).alias("res_y"), F.lit(50).alias("width"), F.lit(50).alias("height"))
    terrain = d.where("x < 40").select(*CELL, "dem")
    trend = d.where("y < 20").select(*CELL, F.col("s2_scl").alias("trend"))
    return geometry.assemble(d.select(*CELL, r6("red").alias("red")), grid, [(terrain, grid), (trend, grid)], {"trend": 0})


@query(f"{_P} SELECT t.tile_id, t.y, t.x, s.dem FROM pixels t LEFT JOIN pixels s ON s.tile_id = t.tile_id AND s.y = CAST(floor(t.y * 0.5 + 0.25 + 0.5) AS INT) AND s.x = CAST(floor(t.x * 0.5 + 3.25 + 0.5) AS INT)")
def f3_resample_nearest(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return geometry.resample(p.select(*CELL, "dem"), p.select(*CELL), "dem", 0.5, 3.25, 0.25)


_WEIGHT = "CASE WHEN abs({d}) <= 1 THEN 1.5 * abs({d}) * abs({d}) * abs({d}) - 2.5 * abs({d}) * abs({d}) + 1 WHEN abs({d}) < 2 THEN -0.5 * abs({d}) * abs({d}) * abs({d}) + 2.5 * abs({d}) * abs({d}) - 4 * abs({d}) + 2 ELSE 0.0 END"


@query(
    f"{_P}, n AS (SELECT t.tile_id, t.y, t.x, s.dem, ({_WEIGHT.format(d='(t.x * 0.5 + 3.25 - s.x)')}) * ({_WEIGHT.format(d='(t.y * 0.5 + 0.25 - s.y)')}) AS w FROM pixels t JOIN pixels s ON s.tile_id = t.tile_id AND s.y BETWEEN floor(t.y * 0.5 + 0.25) - 1 AND floor(t.y * 0.5 + 0.25) + 2 AND s.x BETWEEN floor(t.x * 0.5 + 3.25) - 1 AND floor(t.x * 0.5 + 3.25) + 2) "
    "SELECT tile_id, y, x, round(sum(w * dem) / nullif(sum(w), 0), 4) AS dem FROM n GROUP BY tile_id, y, x"
)
def f3_resample_cubic(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return geometry.resample(p.select(*CELL, "dem"), p.select(*CELL), "dem", 0.5, 3.25, 0.25, cubic=True).withColumn("dem", r6("dem", 4))


def _triangle():
    point = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    return F.array(point(5, 5), point(25, 5), point(5, 25), point(5, 5))


@query(f"{_P} SELECT tile_id, y, x, dem FROM pixels WHERE x BETWEEN 5 AND 24 AND y BETWEEN 5 AND 14 AND (x + 0.5 - 5) + (y + 0.5 - 5) < 20")
def f4_crop_to_polygon(spark, sf_dir):
    return geometry.crop(pixels(spark, sf_dir).where(F.col("y").between(5, 14)), _triangle()).select(*CELL, "dem")


@query(f"{_P} SELECT tile_id, y, x, CASE WHEN (x + 0.5 - 5) + (y + 0.5 - 5) < 20 THEN dem END AS dem FROM pixels WHERE x BETWEEN 5 AND 24 AND y BETWEEN 5 AND 24")
def f4_mask_outside_polygon(spark, sf_dir):
    return geometry.crop(pixels(spark, sf_dir), _triangle(), ["dem"]).select(*CELL, "dem")


@query("SELECT c_custkey, CAST(round_even((c_custkey * 10 + 0.0004) / 10, 0) AS BIGINT) AS i FROM customer")
def f5_snap_coordinates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.bround((F.col("c_custkey") * 10 + 0.0004) / 10).cast("long").alias("i"))


_BOXES = "b AS (SELECT c_custkey % 10 AS tile_id, c_custkey % 40 AS x0, c_custkey % 20 AS y0, c_custkey % 40 + 4 AS x1, c_custkey % 20 + 3 AS y1 FROM customer)"


@query(
    f"{DECODED}, {_BOXES}, i AS (SELECT DISTINCT p.tile_id, p.y, p.x FROM decoded p JOIN b ON b.tile_id = p.tile_id AND p.x >= b.x0 AND p.x < b.x1 AND p.y >= b.y0 AND p.y < b.y1) "
    "SELECT p.tile_id, p.y, p.x, CASE WHEN p.clear_sky = 0 OR p.quality <> 2 THEN 2 WHEN i.x IS NOT NULL THEN 1 ELSE 0 END AS label FROM decoded p LEFT JOIN i ON i.tile_id = p.tile_id AND i.y = p.y AND i.x = p.x"
)
def f12_rasterise_labels(spark, sf_dir):
    k = F.col("c_custkey")
    b = table(spark, sf_dir, "customer")
    rings = b.select((k % 10).cast("int").alias("tile_id"), geometry.box_ring(k % 40, k % 20, k % 40 + 4, k % 20 + 3).alias("ring"))
    d = decoded(spark, sf_dir).withColumn("extent", F.col("clear_sky") != 0)
    return geometry.rasterise(d, rings, "extent", "quality").select(*CELL, "label")


_HOLES = "b AS (SELECT c_custkey % 10 AS tile_id, c_custkey % 40 AS x0, c_custkey % 20 AS y0 FROM customer)"


@query(
    f"{DECODED}, {_HOLES}, i AS (SELECT DISTINCT p.tile_id, p.y, p.x FROM decoded p JOIN b ON b.tile_id = p.tile_id AND p.x >= b.x0 AND p.x < b.x0 + 9 AND p.y >= b.y0 AND p.y < b.y0 + 7 WHERE NOT (p.x >= b.x0 + 2 AND p.x < b.x0 + 6 AND p.y >= b.y0 + 2 AND p.y < b.y0 + 5)) "
    "SELECT p.tile_id, p.y, p.x, CASE WHEN p.clear_sky = 0 OR p.quality <> 2 THEN 2 WHEN i.x IS NOT NULL THEN 1 ELSE 0 END AS label FROM decoded p LEFT JOIN i ON i.tile_id = p.tile_id AND i.y = p.y AND i.x = p.x"
)
def f12_rasterise_polygons_with_holes(spark, sf_dir):
    k = F.col("c_custkey")
    x, y = k % 40, k % 20
    rings = F.array(geometry.box_ring(x, y, x + 9, y + 7), geometry.box_ring(x + 2, y + 2, x + 6, y + 5))
    b = table(spark, sf_dir, "customer").select((k % 10).cast("int").alias("tile_id"), rings.alias("rings"))
    d = decoded(spark, sf_dir).withColumn("extent", F.col("clear_sky") != 0)
    return geometry.rasterise(d, b, "extent", "quality").select(*CELL, "label")


_BOTH = lambda a, b, c, d: f"greatest(0, least(f.xmax, {c}) - greatest(f.xmin, {a})) * greatest(0, least(f.ymax, {d}) - greatest(f.ymin, {b}))"
_TOUCHES = lambda a, b, c, d: f"(f.xmin <= {c} AND {a} <= f.xmax AND f.ymin <= {d} AND {b} <= f.ymax)"


@query(
    f"{_F}, r AS (SELECT n_nationkey AS k, n_nationkey * 37 AS x0 FROM nation) SELECT f.image_id, r.k AS region_key, "
    f"CAST({_BOTH('x0', '0', 'x0 + 30', '700')} - CASE WHEN k % 2 = 0 THEN {_BOTH('x0 + 8', '100', 'x0 + 22', '600')} ELSE {_BOTH('x0 + 15', '350', 'x0 + 30', '700')} END AS DOUBLE) AS area, "
    f"CASE WHEN k % 2 = 0 THEN NOT (f.xmin > x0 + 8 AND f.xmax < x0 + 22 AND f.ymin > 100 AND f.ymax < 600) ELSE {_TOUCHES('x0', '0', 'x0 + 15', '700')} OR {_TOUCHES('x0', '0', 'x0 + 30', '350')} END AS meets FROM footprints f JOIN r ON {_TOUCHES('x0', '0', 'x0 + 30', '700')}"
)
def k3_k4_polygon_intersection(spark, sf_dir):
    """Footprints against regions with a hole (even keys) or with a corner cut out (odd keys)."""
    k = F.col("n_nationkey")
    x = k * 37
    point = lambda a, b: F.struct(a.cast("double").alias("x"), F.lit(float(b)).alias("y"))
    holed = F.array(geometry.box_ring(x, F.lit(0), x + 30, F.lit(700)), geometry.box_ring(x + 8, F.lit(100), x + 22, F.lit(600)))
    bent = F.array(F.array(point(x, 0), point(x + 30, 0), point(x + 30, 350), point(x + 15, 350), point(x + 15, 700), point(x, 700), point(x, 0)))
    regions = table(spark, sf_dir, "nation").select(k.alias("key"), F.when(k % 2 == 0, holed).otherwise(bent).alias("polygon"))
    regions = polygons.with_bounds(regions.withColumn("outer", F.element_at("polygon", 1)), "outer").drop("outer")
    footprints, box = load(spark, sf_dir, "footprints"), list(catalog.BOX)
    own = footprints.select(*box).distinct().withColumn("polygon", F.array(geometry.box_ring(*(F.col(c) for c in box))))  # equal boxes are compared once
    pairs = catalog.intersecting(own, regions).select(*box, F.col("r_key").alias("region_key"), "polygon", "r_polygon")
    found = polygons.with_shared_area(pairs, "polygon", "r_polygon", "area")
    found = found.select(*box, "region_key", r6("area").alias("area"), polygons.meet(F.col("polygon"), F.col("r_polygon")).alias("meets"))
    return footprints.join(cut(found), box).select("image_id", "region_key", "area", "meets")


@query(f"{_F} SELECT image_id, (xmax - xmin) * (ymax - ymin) * 1.0::DOUBLE AS area, (xmin + 3) > xmin AND xmin + 3 < xmax AND ymin + 25 < ymax AS inside FROM footprints")
def k3_k4_area_and_contains(spark, sf_dir):
    f = load(spark, sf_dir, "footprints").withColumn("ring", geometry.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))
    inside = geometry.contains(F.col("ring"), F.col("xmin") + 3, F.col("ymin") + 25)
    return f.select("image_id", geometry.area(F.col("ring")).alias("area"), inside.alias("inside"))


@query(f"{cte('footprints', 'scenes')} SELECT f.image_id, s.scene_id, (least(f.xmax, s.xmax) - greatest(f.xmin, s.xmin)) * (least(f.ymax, s.ymax) - greatest(f.ymin, s.ymin)) AS area FROM footprints f JOIN scenes s ON s.xmin <= f.xmax AND f.xmin <= s.xmax AND s.ymin <= f.ymax AND f.ymin <= s.ymax")
def k3_intersection_area(spark, sf_dir):
    footprints, scenes = load(spark, sf_dir, "footprints"), load(spark, sf_dir, "scenes")
    pairs = catalog.overlaps(footprints.select("image_id", *catalog.BOX), scenes.select("scene_id", *catalog.BOX))
    return pairs.select("image_id", F.col("r_scene_id").alias("scene_id"), "area")


@query(f"{_F} SELECT image_id, xmin + 2.5::DOUBLE AS xmin, ymax - 1.5::DOUBLE AS ymax FROM footprints")
def k6_translate(spark, sf_dir):
    f = load(spark, sf_dir, "footprints").withColumn("ring", geometry.translate(geometry.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")), F.lit(2.5), F.lit(-1.5)))
    return f.select("image_id", F.array_min(F.transform("ring", lambda p: p["x"])).alias("xmin"), F.array_max(F.transform("ring", lambda p: p["y"])).alias("ymax"))


@query(f"{_F} SELECT image_id, image_id % 9 IN (0, 5, 8) AS valid FROM footprints")
def k7_valid_rings(spark, sf_dir):
    """Boxes, bows, open rings, spikes, rings that touch themselves, repeated corners, rings without area, edges that lie on each other, and bends."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in catalog.BOX)
    xm, ym = (x0 + x1) / 2, (y0 + y1) / 2
    ring = lambda *points: F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in points))
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    a, b, c, d = corners
    kinds = [
        ring(*corners, a),
        ring(a, b, d, c, a),
        ring(*corners),
        ring(a, b, c, (xm, y1), (xm, y1 + 5), (xm, y1), d, a),
        ring(a, (xm, y0), b, c, (xm, y0), d, a),
        ring(a, b, b, c, c, c, d, a),
        ring(a, (xm, ym), c, (xm, ym), a),
        ring(a, b, c, (xm, y1), (xm, y0), (x0 + 1, y0), d, a),
        ring(a, b, c, (xm, ym), d, a),
    ]
    k = F.col("image_id") % len(kinds)
    chosen = F.when(k == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        chosen = chosen.when(k == i, kind)
    return load(spark, sf_dir, "footprints").select("image_id", polygons.valid(chosen).alias("valid"))


@query(
    "WITH p AS (SELECT o_orderkey, o_orderkey % 180 - 90 + 0.5 AS lat, o_orderkey * 7 % 360 - 180 + 0.5 AS lon FROM orders) SELECT o_orderkey, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32 "
    "WHEN lat >= 72 AND lat < 84 AND lon >= 0 AND lon < 9 THEN 31 WHEN lat >= 72 AND lat < 84 AND lon >= 9 AND lon < 21 THEN 33 WHEN lat >= 72 AND lat < 84 AND lon >= 21 AND lon < 33 THEN 35 WHEN lat >= 72 AND lat < 84 AND lon >= 33 AND lon < 42 THEN 37 ELSE floor((lon + 180) / 6) + 1 END AS INT) AS epsg FROM p"
)
def k8_utm_zones(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", geometry.utm_zone((k % 180 - 90 + 0.5).cast("double"), (k * 7 % 360 - 180 + 0.5).cast("double")).alias("epsg"))


def _projections_sql() -> str:
    """Krueger's series and the polar projection, written out."""
    from math import pi, radians, sin, sqrt, tan

    f = geometry.FLATTENING
    n = f / (2 - f)
    scale = geometry.UTM_SCALE * geometry.AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    e1, e = 2 * n**0.5 / (1 + n), sqrt(f * (2 - f))
    terms = enumerate((n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240), 1)
    east, north = zip(*((f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)", f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)") for j, a in terms))
    c = radians(70.0)
    m = geometry.AXIS * sqrt(1 - sin(c) ** 2) / sqrt(1 - e * e * sin(c) ** 2) / (tan(pi / 4 - c / 2) / ((1 - e * sin(c)) / (1 + e * sin(c))) ** (e / 2))
    return (
        "WITH p AS (SELECT o_orderkey, o_orderkey % 80 + 0.25::DOUBLE AS lat, o_orderkey * 7 % 360 - 180 + 0.25::DOUBLE AS lon FROM orders), "
        "z AS (SELECT *, CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32 WHEN lat >= 72 AND lon >= 0 AND lon < 9 THEN 31 WHEN lat >= 72 AND lon >= 9 AND lon < 21 THEN 33 WHEN lat >= 72 AND lon >= 21 AND lon < 33 THEN 35 WHEN lat >= 72 AND lon >= 33 AND lon < 42 THEN 37 ELSE floor((lon + 180) / 6) + 1 END AS zone FROM p), "
        f"t AS (SELECT *, radians(lon - (zone * 6 - 183)) AS lam, sinh(atanh(sin(radians(lat))) - {e1!r} * atanh({e1!r} * sin(radians(lat)))) AS t FROM z), "
        "s AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(t * t + 1)) AS eta FROM t), "
        f"q AS (SELECT *, {m!r} * tan(pi() / 4 - radians(lat) / 2) / power((1 - {e!r} * sin(radians(lat))) / (1 + {e!r} * sin(radians(lat))), {e / 2!r}) AS rho FROM s) "
        f"SELECT o_orderkey, round(500000 + {scale!r} * (eta + {' + '.join(east)}), 3) + 0.0 AS east, round({scale!r} * (xi + {' + '.join(north)}), 3) + 0.0 AS north, "
        "round(rho * sin(radians(lon + 45)), 3) + 0.0 AS polar_x, round(-rho * cos(radians(lon + 45)), 3) + 0.0 AS polar_y FROM q"
    )


@query(_projections_sql())
def k9_projections(spark, sf_dir):
    k = F.col("o_orderkey")
    lat, lon = (k % 80).cast("double") + 0.25, (k * 7 % 360 - 180).cast("double") + 0.25
    east, north = geometry.to_utm(lat, lon, geometry.utm_zone(lat, lon))
    x, y = geometry.to_polar(lat, lon)
    return table(spark, sf_dir, "orders").select("o_orderkey", r6(east, 3).alias("east"), r6(north, 3).alias("north"), r6(x, 3).alias("polar_x"), r6(y, 3).alias("polar_y"))


_NAME = "o_orderkey % 300 || CASE WHEN o_orderkey % 2 = 0 THEN 'U' ELSE 'D' END || o_orderkey % 70 || CASE WHEN o_orderkey % 3 = 0 THEN 'L' ELSE 'R' END"


@query("SELECT o_orderkey, CAST((o_orderkey % 300) * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS INT) AS grid_row, CAST((o_orderkey % 70) * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS INT) AS grid_col FROM orders")
def k10_k12_grid_index(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(f"concat({_NAME.replace(' || ', ', ')})").alias("name"))
    row, col = geometry.grid_index(F.col("name"))
    return o.select("o_orderkey", row.alias("grid_row"), col.alias("grid_col"))


#: Points of orders: every order has a place on the globe.
_POINTS = "p AS (SELECT o_orderkey, o_orderkey % 179 - 89 + 0.25 AS plat, o_orderkey * 7 % 360 - 180 + 0.25 AS plon FROM orders)"


def _grid_sql() -> str:
    return (
        f"WITH {_POINTS}, n AS (SELECT 50.0 AS d, CAST(ceil(pi() * 6378.137 / 50.0) AS BIGINT) AS n), r AS (SELECT i, n, d, i * (180.0 / n) - 90.0 AS lat, i - CASE WHEN n % 2 = 0 THEN n // 2 ELSE n // 2 + 1 END AS grid_row FROM n, range(0, 500) t(i) WHERE i < n), "
        "c AS (SELECT *, greatest(CAST(ceil(cos(radians(lat)) * (2 * pi() * 6378.137 / d)) AS BIGINT), 1) AS nc FROM r), k AS (SELECT *, unnest(range(0, nc)) AS k FROM c), "
        "x AS (SELECT i, k, grid_row, k - nc // 2 AS grid_col, lat, k * (360.0 / nc) - 180.0 AS lon, 180.0 / n AS height, 360.0 / nc AS width, abs(grid_row) || CASE WHEN grid_row < 0 THEN 'D' ELSE 'U' END || abs(k - nc // 2) || CASE WHEN k - nc // 2 <= 0 THEN 'L' ELSE 'R' END AS name FROM k), "
        "a AS (SELECT o_orderkey, CAST(floor((plat + 90) / (180.0 / n)) AS BIGINT) AS i, plon FROM p, n), q AS (SELECT a.o_orderkey, a.i, CAST(floor((plon + 180) / (360.0 / nc)) AS BIGINT) AS k FROM a JOIN c ON c.i = a.i) "
    )


def _cells_of_points(spark, sf_dir):
    """Each order's grid cell, by the cell's row and column."""
    rows = geometry.grid_rows(spark, 50.0)
    k = F.col("o_orderkey")
    points = table(spark, sf_dir, "orders").select("o_orderkey", (k % 179 - 89 + 0.25).cast("double").alias("plat"), (k * 7 % 360 - 180 + 0.25).cast("double").alias("plon"))
    placed = points.select("o_orderkey", "plon", geometry.grid_row_of(F.col("plat"), 50.0).alias("row"))
    placed = placed.join(rows.select("row", "n_cols"), "row").select("o_orderkey", "row", geometry.grid_col_of(F.col("plon"), F.col("n_cols")).alias("col"))
    return placed.join(geometry.grid_cells(rows), ["row", "col"])


@query(_grid_sql() + "SELECT o_orderkey, CAST(grid_row AS INT) AS grid_row, CAST(grid_col AS INT) AS grid_col, name, round(lat, 6) + 0.0 AS lat, round(lon, 6) + 0.0 AS lon FROM q JOIN x ON x.i = q.i AND x.k = q.k")
def k11_grid_cells(spark, sf_dir):
    cells = _cells_of_points(spark, sf_dir)
    return cells.select("o_orderkey", F.col("row").alias("grid_row"), F.col("col").alias("grid_col"), "name", r6("lat").alias("lat"), r6("lon").alias("lon"))


_WITHIN = "lat BETWEEN 50 - height AND 75 AND lon BETWEEN -150 - width AND -100"
_CORNERS = ((-150.3, 49.7), (-99.9, 51.1), (-124.7, 75.2))


def _in_triangle(x: str, y: str) -> str:
    (ax, ay), (bx, by), (cx, cy) = _CORNERS
    left = lambda px, py, qx, qy: f"({qx} - {px}) * ({y} - {py}) - ({qy} - {py}) * ({x} - {px}) > 0"
    return f"({left(ax, ay, bx, by)} AND {left(bx, by, cx, cy)} AND {left(cx, cy, ax, ay)})"


@query(_grid_sql() + f"SELECT name, count(*) AS n FROM q JOIN x ON x.i = q.i AND x.k = q.k WHERE {_WITHIN} GROUP BY name")
def k13_grid_within(spark, sf_dir):
    return geometry.grid_within(_cells_of_points(spark, sf_dir), 50, -150, 75, -100).groupBy("name").agg(F.count("*").alias("n"))


@query(
    _grid_sql() + f"SELECT name, count(*) AS n FROM q JOIN x ON x.i = q.i AND x.k = q.k WHERE lat BETWEEN 49.7 - height AND 75.2 AND lon BETWEEN -150.3 - width AND -99.9 "
    f"AND ({' OR '.join(_in_triangle(x, y) for x in ('lon', '(lon + width)') for y in ('lat', '(lat + height)'))}) GROUP BY name"
)
def k13_grid_within_polygon(spark, sf_dir):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in (*_CORNERS, _CORNERS[0])))
    xs, ys = zip(*_CORNERS)
    return geometry.grid_within(_cells_of_points(spark, sf_dir), min(ys), min(xs), max(ys), max(xs), ring).groupBy("name").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST(o_orderkey % 80 + 0.25 AS DOUBLE) AS lat, CAST(o_orderkey * 7 % 360 - 180 + 0.25 AS DOUBLE) AS lon FROM orders")
def k9_round_trip(spark, sf_dir):
    """Latitude and longitude through their UTM zone and back."""
    k = F.col("o_orderkey")
    lat, lon = (k % 80).cast("double") + 0.25, (k * 7 % 360 - 180).cast("double") + 0.25
    zoned = table(spark, sf_dir, "orders").select("o_orderkey", lat.alias("lat"), lon.alias("lon"), geometry.utm_zone(lat, lon).alias("epsg"))
    east, north = geometry.to_utm(F.col("lat"), F.col("lon"), F.col("epsg"))
    placed = zoned.select("o_orderkey", "epsg", east.alias("east"), north.alias("north"))
    back = geometry.from_utm(F.col("east"), F.col("north"), F.col("epsg"))
    return placed.select("o_orderkey", r6(back[0], 5).alias("lat"), r6(back[1], 5).alias("lon"))


@query("SELECT c_custkey AS tile_id, 500000.0::DOUBLE + c_custkey * 10 AS xmin, 4500000.0::DOUBLE + c_custkey - 300 AS ymin, 500000.0::DOUBLE + c_custkey * 10 + 500 AS xmax, 4500000.0::DOUBLE + c_custkey AS ymax FROM customer")
def k14_tile_extents(spark, sf_dir):
    k = F.col("c_custkey")
    tiles = table(spark, sf_dir, "customer").select(k.alias("tile_id"), (k * 10 + 500000.0).alias("x0"), (k + 4500000.0).alias("y0"), F.lit(10.0).alias("res_x"), F.lit(-10.0).alias("res_y"), F.lit(50).alias("width"), F.lit(30).alias("height"))
    return geometry.tile_extent(tiles)
