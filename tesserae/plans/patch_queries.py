"""Queries over patches and training sets."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tesserae.functions.storage import cut
from tesserae.operators import patches
from tesserae.plans.base import CELL, DECODED, decoded, pixels, query, r6
from tesserae.sources import products
from tesserae.sources.adapters import HEIGHT, WIDTH, cte, table

_P = cte("pixels")
SIZE, OVERLAP = 16, 4


def tiles(p):
    return p.select("tile_id").distinct().withColumns({"height": F.lit(HEIGHT), "width": F.lit(WIDTH)})


def _origins(p, size=SIZE, overlap=OVERLAP):
    return patches.origins(tiles(p), size, overlap)


_STEP = SIZE - OVERLAP
_O = (
    f"o AS (SELECT tile_id, CAST(py * {(WIDTH - OVERLAP - 1) // _STEP + 1} + px AS INT) AS patch_id, CAST(py AS INT) AS patch_idx_y, CAST(px AS INT) AS patch_idx_x, CAST(least(py * {_STEP}, {HEIGHT - SIZE}) AS INT) AS y0, CAST(least(px * {_STEP}, {WIDTH - SIZE}) AS INT) AS x0 "
    f"FROM (SELECT DISTINCT tile_id FROM pixels) t CROSS JOIN range(0, {(HEIGHT - OVERLAP - 1) // _STEP + 1}) a(py) CROSS JOIN range(0, {(WIDTH - OVERLAP - 1) // _STEP + 1}) b(px))"
)
_C = f"{DECODED}, {_O}, c AS (SELECT o.patch_id, o.y0, o.x0, p.y - o.y0 AS dy, p.x - o.x0 AS dx, p.* FROM o JOIN decoded p ON p.tile_id = o.tile_id AND p.y BETWEEN o.y0 AND o.y0 + {SIZE - 1} AND p.x BETWEEN o.x0 AND o.x0 + {SIZE - 1})"
_RAMP = "CASE WHEN {d} < 4 THEN {d} / 3 WHEN {d} >= 12 THEN (15 - {d}) / 3 ELSE 1.0 END"


@query(f"{_P}, {_O} SELECT * FROM o")
def h1_patch_origins(spark, sf_dir):
    return _origins(pixels(spark, sf_dir))


@query(f"{_C} SELECT tile_id, patch_id, count(*) AS n, sum(red_dn) AS red, min(dy) AS dy0, max(dx) AS dx1 FROM c GROUP BY tile_id, patch_id")
def h2_cut_patches(spark, sf_dir):
    p = pixels(spark, sf_dir)
    cells = patches.cut(p, _origins(p), SIZE)
    return cells.groupBy("tile_id", "patch_id").agg(F.count("*").alias("n"), F.sum("red_dn").alias("red"), F.min("dy").alias("dy0"), F.max("dx").alias("dx1"))


_W = f"w AS (SELECT *, ({_RAMP.format(d='dy')}) * ({_RAMP.format(d='dx')}) AS w FROM c)"


@query(f"{_C}, {_W} SELECT tile_id, y, x, round(sum(1 / (1 + exp(-2 * prob_a)) * w) / CASE WHEN sum(w) = 0 THEN 1.0 ELSE sum(w) END, 6) + 0.0 AS p FROM w GROUP BY tile_id, y, x")
def h3_g3_blend_patches(spark, sf_dir):
    p = pixels(spark, sf_dir)
    cells = patches.cut(p.select(*CELL, "prob_a"), _origins(p), SIZE).withColumn("p", patches.logistic({"prob_a": 2.0}, 0.0))
    return patches.blend(cells, SIZE, OVERLAP).withColumn("p", r6("p"))


@query(
    f"{_P}, g AS (SELECT tile_id, y, x, CASE WHEN y < 0 THEN -y WHEN y > {HEIGHT - 1} THEN {2 * HEIGHT - 2} - y ELSE y END AS sy, CASE WHEN x < 0 THEN -x WHEN x > {WIDTH - 1} THEN {2 * WIDTH - 2} - x ELSE x END AS sx "
    f"FROM (SELECT DISTINCT tile_id FROM pixels) t CROSS JOIN range(-5, {HEIGHT + 5}) a(y) CROSS JOIN range(-5, {WIDTH + 5}) b(x)) SELECT g.tile_id, CAST(g.y AS INT) AS y, CAST(g.x AS INT) AS x, p.red_dn FROM g JOIN pixels p ON p.tile_id = g.tile_id AND p.y = g.sy AND p.x = g.sx"
)
def h4_reflect_padding(spark, sf_dir):
    return patches.pad_reflect(pixels(spark, sf_dir).select(*CELL, "red_dn"), 5, WIDTH, HEIGHT)


@query(f"{_C} SELECT tile_id, patch_id, y, x, round(1 / (1 + exp(-2 * prob_a)), 6) AS p FROM c")
def h5_score_patches(spark, sf_dir):
    p = pixels(spark, sf_dir)
    cells = patches.cut(p.select(*CELL, "prob_a"), _origins(p), SIZE)
    scored = patches.score_patches(cells, ["prob_a"], lambda a: 1 / (1 + np.exp(-2 * a[0])), SIZE)
    return scored.select("tile_id", "patch_id", "y", "x", r6("p").alias("p"))


_KEPT = f"k AS (SELECT tile_id, patch_id, sum(CASE WHEN target <> 2 THEN 1 ELSE 0 END) / 256 AS labelled, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS positives, least(count(red), count(nir), 256) AS least FROM c GROUP BY tile_id, patch_id HAVING sum(CASE WHEN target <> 2 THEN 1 ELSE 0 END) / 256 >= 0.9 AND least(count(red), count(nir)) > 0)"


def _kept(spark, sf_dir):
    d = decoded(spark, sf_dir)
    o = _origins(d)
    cells = patches.cut(d.select(*CELL, "red", "nir", "target"), o, SIZE)
    return cells, o, patches.training_patches(cells, ["red", "nir"], "target", SIZE, min_labelled=0.9)


@query(f"{_C}, {_KEPT} SELECT tile_id, patch_id, round(labelled, 6) AS labelled, positives, least FROM k")
def h7_training_patches(spark, sf_dir):
    return _kept(spark, sf_dir)[2].withColumn("labelled", r6("labelled"))


@query(f"{_C}, {_KEPT} SELECT 7 + row_number() OVER (ORDER BY k.tile_id, k.patch_id) - 1 AS z_idx, k.tile_id, k.patch_id, o.patch_idx_y, o.patch_idx_x, k.positives = 0 AS is_empty, o.x0 AS x, o.y0 AS y, CAST(s.c_nationkey AS BIGINT) AS region, CAST(s.c_custkey * 3 AS BIGINT) AS sample_id, o.x0 AS xmin, o.y0 AS ymin, o.x0 + 16 AS xmax, o.y0 + 16 AS ymax FROM k JOIN o ON o.tile_id = k.tile_id AND o.patch_id = k.patch_id LEFT JOIN customer s ON s.c_custkey = k.tile_id")
def h8_patch_metadata(spark, sf_dir):
    _, o, kept = _kept(spark, sf_dir)
    samples = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("tile_id"), F.col("c_nationkey").cast("long").alias("region"), (F.col("c_custkey") * 3).cast("long").alias("sample_id"))
    return patches.patch_metadata(kept, o, first=7, samples=samples, size=SIZE)


@query(
    f"{_C}, v AS (SELECT tile_id, patch_id, target, unnest([{{'variant': 0, 'dy': dy, 'dx': dx}}, {{'variant': 1, 'dy': dx, 'dx': 15 - dy}}, {{'variant': 2, 'dy': 15 - dy, 'dx': 15 - dx}}, {{'variant': 3, 'dy': 15 - dx, 'dx': dy}}, "
    "{'variant': 4, 'dy': dy, 'dx': 15 - dx}, {'variant': 5, 'dy': dx, 'dx': dy}, {'variant': 6, 'dy': 15 - dy, 'dx': dx}, {'variant': 7, 'dy': 15 - dx, 'dx': 15 - dy}]) AS v FROM c) "
    "SELECT patch_id, v.variant AS variant, sum(target * (v.dy * 16 + v.dx)) AS signature FROM v GROUP BY patch_id, v.variant"
)
def h13_symmetries(spark, sf_dir):
    p = pixels(spark, sf_dir)
    cells = patches.augment(patches.cut(p.select(*CELL, "target"), _origins(p), SIZE), SIZE)
    return cells.groupBy("patch_id", "variant").agg(F.sum(F.col("target") * (F.col("dy") * 16 + F.col("dx"))).alias("signature"))


@query(f"{_P} SELECT tile_id, y, x, (red_dn % 256) & 252 AS red FROM pixels")
def h13_posterize(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, patches.posterize(F.col("red_dn") % 256).alias("red"))


@query(f"{_C}, {_KEPT}, z AS (SELECT row_number() OVER (ORDER BY tile_id, patch_id) - 1 AS z_idx, tile_id, patch_id FROM k) SELECT z.z_idx, count(*) AS n, CAST(sum(coalesce(CASE WHEN c.red IS NOT NULL THEN c.red_dn END, 0) * (c.dy * 16 + c.dx)) AS BIGINT) AS red, sum(c.target * (c.dy * 16 + c.dx)) AS target FROM z JOIN c ON c.tile_id = z.tile_id AND c.patch_id = z.patch_id GROUP BY z.z_idx")
def a19_training_tables(spark, sf_dir):
    cells, o, kept = _kept(spark, sf_dir)
    cells = cells.withColumn("red", F.round((F.col("red") + 0.1) * 10000))
    meta = patches.patch_metadata(kept, o)
    x, y = products.split_values(cut(products.patch_values(cells, meta, ["red"], "target", SIZE)), ["red"])
    dot = lambda v: F.aggregate(F.transform(v, lambda a, i: a.cast("double") * i), F.lit(0.0), lambda s, a: s + a)
    both = x.select("z_idx", F.size("values").cast("long").alias("n"), dot("values").cast("long").alias("red")).join(y.select("z_idx", dot("values").cast("long").alias("target")), "z_idx")
    return both
