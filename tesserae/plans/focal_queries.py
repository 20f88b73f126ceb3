"""Queries over neighbourhoods of cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import focal
from tesserae.plans.base import CELL, pixels, query, r6
from tesserae.sources.adapters import HEIGHT, WIDTH, cte

_P = cte("pixels")
_K = f"{_P}, z AS (SELECT tile_id, y, x, dem FROM pixels)"


def _around(name: str, dy: int, dx: int) -> str:
    return f"max(CASE WHEN b.y = a.y + {dy} AND b.x = a.x + {dx} THEN b.dem END) AS {name}"


_N = (
    f"{_K}, n AS (SELECT a.tile_id, a.y, a.x, a.dem, count(*) AS k, "
    + ", ".join(_around(n, dy, dx) for n, dy, dx in (("a", -1, -1), ("b", -1, 0), ("c", -1, 1), ("d", 0, -1), ("f", 0, 1), ("g", 1, -1), ("h", 1, 0), ("i", 1, 1)))
    + " FROM z a JOIN z b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.tile_id, a.y, a.x, a.dem), "
    "s AS (SELECT *, CASE WHEN k = 9 THEN ((c + 2 * f + i) - (a + 2 * d + g)) / 80 END AS dx, CASE WHEN k = 9 THEN ((g + 2 * h + i) - (a + 2 * b + c)) / 80 END AS dy FROM n)"
)
_ASPECT = "CASE WHEN dx = 0 AND dy = 0 THEN -1.0 WHEN dx IS NOT NULL THEN ((90 - degrees(atan2(dy, -dx))) % 360 + 360) % 360 END"
_SHADE = "sin(radians(25)) * cos(atan(sqrt(dx * dx + dy * dy))) + cos(radians(25)) * sin(atan(sqrt(dx * dx + dy * dy))) * cos(radians(90 - 225) - atan2(dy, -dx))"
_TERRAIN = f"{_N}, t AS (SELECT *, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope, {_ASPECT} AS aspect, CASE WHEN dx IS NOT NULL THEN least(greatest({_SHADE}, 0.0), 1.0) END AS hillshade, CASE WHEN k = 9 THEN ((d + f) / 2 - dem + (b + h) / 2 - dem) * -2 * 100 / 100 END AS curvature FROM s)"


@query(f"{_TERRAIN} SELECT tile_id, y, x, round(slope, 6) AS slope, round(aspect, 4) + 0.0 AS aspect, round(hillshade, 6) + 0.0 AS hillshade, round(curvature, 6) + 0.0 AS curvature FROM t")
def e4_e7_e16_terrain(spark, sf_dir):
    t = focal.terrain(pixels(spark, sf_dir).select(*CELL, "dem"))
    return t.select(*CELL, r6("slope").alias("slope"), r6("aspect", 4).alias("aspect"), r6("hillshade").alias("hillshade"), r6("curvature").alias("curvature"))


_OWN = _SHADE.replace("radians(25)", "radians(20 + tile_id % 30)").replace("radians(90 - 225)", "radians(90 - ((180 + tile_id * 10 + m.c) % 360 + 360) % 360)")


@query(f"{_N}, m AS (SELECT tile_id, degrees(atan2(avg(x + tile_id * 50 + 1), avg(y + 1))) + 90 AS c FROM z GROUP BY tile_id) SELECT s.tile_id, y, x, round(CASE WHEN dx IS NOT NULL THEN least(greatest({_OWN.replace('tile_id', 's.tile_id')}, 0.0), 1.0) END, 5) + 0.0 AS hillshade FROM s JOIN m ON m.tile_id = s.tile_id")
def e5_hillshade_of_own_sun(spark, sf_dir):
    """Each tile under its own sun, whose azimuth is turned to the tile's grid."""
    p = pixels(spark, sf_dir).select(*CELL, "dem").withColumns({"px": F.col("x") + F.col("tile_id") * 50 + 1, "py": F.col("y") + 1})
    tiles = p.select("tile_id").distinct().select("tile_id", (F.col("tile_id") * 10 + 180.0).alias("azimuth"), (F.col("tile_id") % 30 + 20.0).alias("elevation"))
    t = focal.terrain(focal.with_sun(p, tiles, "px", "py"), azimuth=F.col("azimuth"), altitude=F.col("elevation"))
    return t.select(*CELL, r6("hillshade", 5).alias("hillshade"))


@query(f"{_TERRAIN}, m AS (SELECT tile_id, degrees(atan2(avg(x + tile_id * 50 + 1), avg(y + 1))) + 90 AS c FROM t GROUP BY tile_id) SELECT t.tile_id, y, x, round(CASE WHEN aspect = -1 THEN -1.0 ELSE (aspect + m.c) % 360 END, 4) + 0.0 AS aspect FROM t JOIN m ON m.tile_id = t.tile_id")
def e6_true_north(spark, sf_dir):
    t = focal.terrain(pixels(spark, sf_dir).select(*CELL, "dem"))
    placed = t.withColumns({"px": F.col("x") + F.col("tile_id") * 50 + 1, "py": F.col("y") + 1})
    c = focal.sun_correction(placed, "px", "py")
    return t.join(c, "tile_id").select(*CELL, r6(focal.true_north(F.col("aspect"), F.col("correction")), 4).alias("aspect"))


def _disk(r: int, inner: int = 0) -> str:
    d = "(b.y - a.y) * (b.y - a.y) + (b.x - a.x) * (b.x - a.x)"
    low = f" AND {d} > {inner * inner}" if inner else ""
    return (
        f"{_K}, d AS (SELECT a.tile_id, a.y, a.x, a.dem, sum(CASE WHEN {d} <= {r * r}{low} THEN b.dem END) AS s, sum(CASE WHEN {d} <= {r * r} THEN 1 ELSE 0 END) AS n, sum(CASE WHEN {d} <= {r * r}{low} THEN 1 ELSE 0 END) AS m "
        f"FROM z a JOIN z b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - {r} AND a.y + {r} AND b.x BETWEEN a.x - {r} AND a.x + {r} GROUP BY a.tile_id, a.y, a.x, a.dem) "
        f"SELECT tile_id, y, x, round(CASE WHEN n = {focal.disk_size(r)} THEN dem - s / m END, 6) + 0.0 AS relative_elevation FROM d"
    )


@query(_disk(3))
def e2_tpi_disk(spark, sf_dir):
    return focal.tpi(pixels(spark, sf_dir).select(*CELL, "dem"), outer=3).select(*CELL, r6("relative_elevation").alias("relative_elevation"))


@query(_disk(4, 2))
def e3_tpi_ring(spark, sf_dir):
    return focal.tpi(pixels(spark, sf_dir).select(*CELL, "dem"), outer=4, inner=2).select(*CELL, r6("relative_elevation").alias("relative_elevation"))


@query(
    f"{_K} SELECT a.tile_id, a.y, a.x, round(CASE WHEN count(*) = 9 THEN sqrt(greatest(sum((a.dem - b.dem) * (a.dem - b.dem)), 0.0)) END, 4) + 0.0 AS tri FROM z a JOIN z b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.tile_id, a.y, a.x"
)
def e8_ruggedness(spark, sf_dir):
    t = focal.tri(pixels(spark, sf_dir).select(*CELL, "dem"))
    return t.select(*CELL, r6("tri", 4).alias("tri"))


@query(
    f"{_TERRAIN}, v AS (SELECT tile_id, y, x, CASE WHEN aspect = -1 THEN 0.0 ELSE sin(radians(slope)) * sin(radians(aspect)) END AS vx, CASE WHEN aspect = -1 THEN 0.0 ELSE sin(radians(slope)) * cos(radians(aspect)) END AS vy, cos(radians(slope)) AS vz FROM t) "
    "SELECT a.tile_id, a.y, a.x, round(CASE WHEN count(b.vz) = 9 THEN 1 - sqrt(power(sum(b.vx) / 9, 2) + power(sum(b.vy) / 9, 2) + power(sum(b.vz) / 9, 2)) END, 6) + 0.0 AS vrm FROM v a JOIN v b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.tile_id, a.y, a.x"
)
def e9_vector_ruggedness(spark, sf_dir):
    t = focal.terrain(pixels(spark, sf_dir).select(*CELL, "dem")).select(*CELL, "slope", "aspect")
    return focal.vrm(t).select(*CELL, r6("vrm").alias("vrm"))


@query(
    f"{_K}, w AS (SELECT a.tile_id, a.y, a.x, count(*) AS n, min(b.dem) AS lo, max(b.dem) AS hi FROM z a JOIN z b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 2 AND a.y + 2 AND b.x BETWEEN a.x - 2 AND a.x + 2 GROUP BY a.tile_id, a.y, a.x) "
    "SELECT tile_id, y, x, round(CASE WHEN n = 25 THEN CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / nullif(hi, 0) END END, 6) AS dissection FROM w"
)
def e10_dissection(spark, sf_dir):
    return focal.dissection(pixels(spark, sf_dir).select(*CELL, "dem"), size=5).select(*CELL, r6("dissection").alias("dissection"))


@query(
    f"{_P}, m AS (SELECT tile_id, y, x, s2_scl <> 0 AS ok FROM pixels) SELECT a.tile_id, a.y, a.x, sum(CASE WHEN NOT b.ok AND (b.y - a.y) * (b.y - a.y) + (b.x - a.x) * (b.x - a.x) <= 4 THEN 1 ELSE 0 END) = 0 AS eroded "
    "FROM m a JOIN m b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 2 AND a.y + 2 AND b.x BETWEEN a.x - 2 AND a.x + 2 GROUP BY a.tile_id, a.y, a.x"
)
def e11_erode_disk(spark, sf_dir):
    p = pixels(spark, sf_dir).select(*CELL, (F.col("s2_scl") != 0).alias("ok"))
    return focal.erode_disk(p, "ok", 2).select(*CELL, "eroded")


@query(f"{_P} SELECT tile_id, y, x, s2_scl <> 0 AND NOT (y < 3 OR y >= {HEIGHT} - 3 OR x < 3 OR x >= {WIDTH} - 3) AS valid FROM pixels")
def e12_drop_edge(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, focal.drop_edge(F.col("s2_scl") != 0, WIDTH, HEIGHT, 3).alias("valid"))


_ERODED = (
    f"{_P}, m AS (SELECT tile_id, y, x, target <> 2 AS ok FROM pixels), e AS (SELECT a.tile_id, a.y, a.x, a.ok, sum(CASE WHEN b.ok THEN 1 ELSE 0 END) = 9 AS eroded "
    "FROM m a JOIN m b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.tile_id, a.y, a.x, a.ok)"
)


@query(f"{_ERODED} SELECT tile_id, y, x, eroded FROM e")
def e13_erode_square(spark, sf_dir):
    p = pixels(spark, sf_dir).select(*CELL, (F.col("target") != 2).alias("ok"))
    return focal.erode_square(p, "ok").select(*CELL, "eroded")


@query(f"{_ERODED} SELECT tile_id, y, x, ok AND NOT eroded AS boundary FROM e")
def e14_boundary(spark, sf_dir):
    p = pixels(spark, sf_dir).select(*CELL, (F.col("target") != 2).alias("ok"))
    return focal.boundary(p, "ok", WIDTH, HEIGHT, 0.02).select(*CELL, "boundary")


@query(f"{_P} SELECT tile_id, y, x, dem FROM pixels WHERE x BETWEEN 10 - 5 AND 20 + 4 AND y BETWEEN 8 - 5 AND 16 + 4")
def e15_terrain_halo(spark, sf_dir):
    return focal.halo(pixels(spark, sf_dir), (10, 8, 20, 16), focal.buffer_cells(30, 10)).select(*CELL, "dem")
