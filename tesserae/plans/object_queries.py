"""Queries over objects of masks, and metrics of pixels, instances and outlines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import bands, focal, geometry, metrics, objects
from tesserae.plans.base import CELL, DECODED, decoded, pixels, query, r6
from tesserae.sources.adapters import HEIGHT, WIDTH, cte

_P = cte("pixels")


_FIX = lambda names: names.replace("WITH ", "WITH RECURSIVE ", 1)
_FOUR = "abs(b.y - r.y) + abs(b.x - r.x) <= 1"
_T = "SELECT tile_id, y, x FROM pixels WHERE target = 1"
_PR = "SELECT tile_id, y, x FROM pixels WHERE target <> 2 AND (target = 1 AND prob_a >= 0.3 OR prob_b >= 0.93)"

def _walk(name: str, cells: str, reach: str = "abs(b.y - r.y) <= 1 AND abs(b.x - r.x) <= 1") -> str:
    """CTEs that label the cells of a query by a recursive walk; ``name`` has tile_id, y, x, region_id."""
    return (
        f"{name}_m AS ({cells}), {name}_r AS (SELECT tile_id, y, x, y * 1000 + x AS root FROM {name}_m UNION SELECT b.tile_id, b.y, b.x, r.root FROM {name}_r r JOIN {name}_m b ON b.tile_id = r.tile_id AND {reach}), "
        f"{name}_c AS (SELECT tile_id, y, x, min(root) AS root FROM {name}_r GROUP BY tile_id, y, x), {name} AS (SELECT tile_id, y, x, CAST(dense_rank() OVER (PARTITION BY tile_id ORDER BY root) AS INT) AS region_id FROM {name}_c)"
    )


def _target(spark, sf_dir):
    return objects.label(pixels(spark, sf_dir).withColumn("m", F.col("target") == 1), "m")


def _predicted_mask():
    return (F.col("target") != 2) & (((F.col("target") == 1) & (F.col("prob_a") >= 0.3)) | (F.col("prob_b") >= 0.93))


def _predicted(spark, sf_dir):
    return objects.label(pixels(spark, sf_dir).withColumn("m", _predicted_mask()), "m")


_W = _FIX(_P)


@query(f"{_W}, {_walk('t', _T)} SELECT * FROM t")
def k0_components(spark, sf_dir):
    return _target(spark, sf_dir)


@query(f"{_W}, {_walk('t', _T, _FOUR)}, s AS (SELECT tile_id, region_id FROM t GROUP BY tile_id, region_id HAVING count(*) >= 4) SELECT p.tile_id, p.y, p.x, s.region_id IS NOT NULL AS m FROM pixels p LEFT JOIN t ON t.tile_id = p.tile_id AND t.y = p.y AND t.x = p.x LEFT JOIN s ON s.tile_id = t.tile_id AND s.region_id = t.region_id")
def g4_remove_small_objects(spark, sf_dir):
    p = pixels(spark, sf_dir).select(*CELL, (F.col("target") == 1).alias("m"))
    return objects.remove_small(p, "m", 4)


_TOUCH = "SELECT tile_id, y, x FROM pixels WHERE target = 1 OR s2_scl = 0"


@query(f"{_W}, {_walk('t', _TOUCH)}, bad AS (SELECT DISTINCT t.tile_id, t.region_id FROM t JOIN pixels p ON p.tile_id = t.tile_id AND p.y = t.y AND p.x = t.x WHERE p.s2_scl = 0) SELECT p.tile_id, p.y, p.x, t.region_id IS NOT NULL AND b.region_id IS NULL AS m FROM pixels p LEFT JOIN t ON t.tile_id = p.tile_id AND t.y = p.y AND t.x = p.x LEFT JOIN bad b ON b.tile_id = t.tile_id AND b.region_id = t.region_id")
def g5_remove_edge_objects(spark, sf_dir):
    p = pixels(spark, sf_dir).select(*CELL, (F.col("target") == 1).alias("m"), (F.col("s2_scl") != 0).alias("extent"))
    return objects.remove_touching(p, "m", "extent").drop("extent")


@query(
    f"{_W}, {_walk('t', _T)} SELECT t.tile_id, t.region_id, CAST(min(v) AS INT) AS min, CAST(max(v) AS INT) AS max, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) + 0.0 AS std, count(*) AS npixel "
    "FROM t JOIN (SELECT tile_id, y, x, CAST(trunc(prob_a * 100) AS INT) AS v FROM pixels) p ON p.tile_id = t.tile_id AND p.y = t.y AND p.x = t.x GROUP BY t.tile_id, t.region_id"
)
def g1_f16_zonal_statistics(spark, sf_dir):
    p = pixels(spark, sf_dir).withColumn("v", (F.col("prob_a") * 100).cast("int"))
    z = objects.zonal(_target(spark, sf_dir), p, "v")
    return z.withColumns({c: r6(c) for c in ("mean", "median", "std")})


_G6 = (
    f"{_FIX(DECODED)}, ok AS (SELECT *, quality >= 1 AS q FROM decoded), e AS (SELECT a.tile_id, a.y, a.x, sum(CASE WHEN NOT b.q AND (b.y - a.y) * (b.y - a.y) + (b.x - a.x) * (b.x - a.x) <= 1 THEN 1 ELSE 0 END) = 0 AND a.y >= 1 AND a.y < {HEIGHT - 1} AND a.x >= 1 AND a.x < {WIDTH - 1} AS extent "
    "FROM ok a JOIN ok b ON a.tile_id = b.tile_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.tile_id, a.y, a.x), "
    "d AS (SELECT p.*, e.extent, e.extent AND p.prob_a > 0.7 AS m FROM decoded p JOIN e ON e.tile_id = p.tile_id AND e.y = p.y AND e.x = p.x)"
)


@query(
    f"{_G6}, {_walk('t', 'SELECT tile_id, y, x FROM d WHERE m', _FOUR)}, s AS (SELECT tile_id, region_id FROM t GROUP BY tile_id, region_id HAVING count(*) >= 3) "
    "SELECT d.tile_id, d.y, d.x, d.extent, round(CASE WHEN d.extent THEN d.prob_a END, 6) AS p, s.region_id IS NOT NULL AS m FROM d LEFT JOIN t ON t.tile_id = d.tile_id AND t.y = d.y AND t.x = d.x LEFT JOIN s ON s.tile_id = t.tile_id AND s.region_id = t.region_id"
)
def g6_postprocess(spark, sf_dir):
    d = decoded(spark, sf_dir).select(*CELL, "quality", "prob_a").withColumn("q", F.col("quality") >= bands.quality_level("low_quality"))
    d = focal.erode_disk(d, "q", 1).withColumn("extent", focal.drop_edge(F.col("eroded"), WIDTH, HEIGHT, 1))
    d = d.withColumn("p", bands.within(F.col("prob_a"), F.col("extent"))).withColumn("m", bands.binarised(F.col("p"), 0.7))
    return objects.remove_small(d.select(*CELL, "extent", r6("p").alias("p"), "m"), "m", 3)


_EDGES = (
    "e AS (SELECT tile_id, region_id, unnest([{'ax': x, 'ay': y, 'bx': x + 1, 'by': y}, {'ax': x + 1, 'ay': y, 'bx': x + 1, 'by': y + 1}, {'ax': x + 1, 'ay': y + 1, 'bx': x, 'by': y + 1}, {'ax': x, 'ay': y + 1, 'bx': x, 'by': y}]) AS e FROM t), "
    "f AS (SELECT tile_id, region_id, e.ax AS ax, e.ay AS ay, e.bx AS bx, e.by AS \"by\" FROM e)"
)


@query(f"{_W}, {_walk('t', _T)}, {_EDGES} SELECT f.tile_id, f.region_id, f.ax, f.ay, f.bx, f.\"by\" FROM f LEFT JOIN f g ON g.tile_id = f.tile_id AND g.region_id = f.region_id AND g.ax = f.bx AND g.ay = f.\"by\" AND g.bx = f.ax AND g.\"by\" = f.ay WHERE g.ax IS NULL")
def k1_outline_edges(spark, sf_dir):
    return objects.outline_edges(_target(spark, sf_dir))


#: Corners of the rings, from pairs of edges that meet: where two outlines touch, each turns right.
_TURNS = (
    "g AS (SELECT DISTINCT f.* FROM f LEFT JOIN f g ON g.tile_id = f.tile_id AND g.region_id = f.region_id AND g.ax = f.bx AND g.ay = f.\"by\" AND g.bx = f.ax AND g.\"by\" = f.ay WHERE g.ax IS NULL), "
    "d AS (SELECT tile_id, region_id, ax, ay, count(*) AS k FROM g GROUP BY tile_id, region_id, ax, ay), "
    "u AS (SELECT a.tile_id, a.region_id, (a.bx - a.ax) * (b.\"by\" - b.ay) - (a.\"by\" - a.ay) * (b.bx - b.ax) AS turn FROM g a JOIN g b ON b.tile_id = a.tile_id AND b.region_id = a.region_id AND b.ax = a.bx AND b.ay = a.\"by\" JOIN d ON d.tile_id = b.tile_id AND d.region_id = b.region_id AND d.ax = b.ax AND d.ay = b.ay "
    "WHERE d.k = 1 OR (a.bx - a.ax) * (b.\"by\" - b.ay) - (a.\"by\" - a.ay) * (b.bx - b.ax) = 1), "
    "c AS (SELECT tile_id, region_id, sum(CASE WHEN turn <> 0 THEN 1 ELSE 0 END) AS corners, sum(turn) AS net FROM u GROUP BY tile_id, region_id), n AS (SELECT tile_id, region_id, count(*) AS npixel FROM t GROUP BY tile_id, region_id) "
)


@query(f"{_W}, {_walk('t', _T)}, {_EDGES}, {_TURNS} SELECT c.tile_id, c.region_id, n.npixel * 1.0::DOUBLE AS area, CAST(corners AS BIGINT) AS corners, CAST(net // 4 AS BIGINT) AS outer_less_holes FROM c JOIN n ON n.tile_id = c.tile_id AND n.region_id = c.region_id")
def k1_a14_polygons(spark, sf_dir):
    """Rings of each region: their signed areas, their corners, and outer rings less holes."""
    rings = objects.polygons(_target(spark, sf_dir))
    pairs = geometry._pairs(F.col("ring"))
    signed = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"])) / 2
    return rings.withColumn("s", signed).groupBy("tile_id", "region_id").agg(F.sum("s").alias("area"), F.sum(F.size("ring") - 1).alias("corners"), F.sum(F.signum("s").cast("long")).alias("outer_less_holes"))


@query(
    f"{_W}, {_walk('t', _T)}, {_EDGES}, {_TURNS}, s AS (SELECT t.tile_id, t.region_id, min(CAST(trunc(p.prob_a * 100) AS INT)) AS min, max(CAST(trunc(p.prob_a * 100) AS INT)) AS max, count(*) AS npixel FROM t JOIN pixels p ON p.tile_id = t.tile_id AND p.y = t.y AND p.x = t.x GROUP BY t.tile_id, t.region_id) "
    "SELECT s.*, CAST(corners AS BIGINT) AS corners FROM s JOIN c ON c.tile_id = s.tile_id AND c.region_id = s.region_id"
)
def k2_vectorise(spark, sf_dir):
    p = pixels(spark, sf_dir).withColumns({"v": (F.col("prob_a") * 100).cast("int"), "m": F.col("target") == 1})
    rings = objects.vectorise(p, "m", "v")
    return rings.groupBy("tile_id", "region_id", "min", "max", "npixel").agg(F.sum(F.size("ring") - 1).alias("corners"))


def _product(name: str, of: str) -> str:
    return f"SELECT tile_id, 'segments' AS product, '{name}' AS subset, max(region_id) AS regions, count(*) AS npixel FROM {of} GROUP BY tile_id"


@query(f"{_W}, {_walk('t', _T)}, {_walk('q', _PR)} {_product('target', 't')} UNION ALL {_product('predicted', 'q')}")
def a14_polygon_products(spark, sf_dir):
    """Polygons of two subsets, counted with their cells by tile."""
    p = pixels(spark, sf_dir).withColumns({"v": (F.col("prob_a") * 100).cast("int"), "t": F.col("target") == 1, "q": _predicted_mask()})
    found = objects.polygon_products(p, {"target": ("t", "v"), "predicted": ("q", "v")})
    once = found.select("tile_id", "product", "subset", "region_id", "npixel").distinct()  # a row for each ring
    return once.groupBy("tile_id", "product", "subset").agg(F.count("*").cast("int").alias("regions"), F.sum("npixel").alias("npixel"))


_PAIRS = (
    f"{_W}, {_walk('t', _T)}, {_walk('q', _PR)}, i AS (SELECT t.tile_id, t.region_id AS t, q.region_id AS p, count(*) AS n FROM t JOIN q ON q.tile_id = t.tile_id AND q.y = t.y AND q.x = t.x GROUP BY t.tile_id, t.region_id, q.region_id), "
    "st AS (SELECT tile_id, region_id AS t, count(*) AS n FROM t GROUP BY tile_id, region_id), sp AS (SELECT tile_id, region_id AS p, count(*) AS n FROM q GROUP BY tile_id, region_id), "
    "iou AS (SELECT i.tile_id, i.t, i.p, i.n AS inter, i.n / (st.n + sp.n - i.n) AS iou FROM i JOIN st ON st.tile_id = i.tile_id AND st.t = i.t JOIN sp ON sp.tile_id = i.tile_id AND sp.p = i.p), "
    "k AS (SELECT d.tile_id, coalesce(a.n, 0) AS tp, coalesce(c.n, 0) - coalesce(a.n, 0) AS fp, coalesce(b.n, 0) - coalesce(a.n, 0) AS fn FROM (SELECT DISTINCT tile_id FROM pixels) d LEFT JOIN (SELECT tile_id, count(*) AS n FROM iou WHERE iou >= 0.5 GROUP BY tile_id) a ON a.tile_id = d.tile_id "
    "LEFT JOIN (SELECT tile_id, count(*) AS n FROM st GROUP BY tile_id) b ON b.tile_id = d.tile_id LEFT JOIN (SELECT tile_id, count(*) AS n FROM sp GROUP BY tile_id) c ON c.tile_id = d.tile_id)"
)


@query(f"{_PAIRS} SELECT tile_id, t, p, inter, round(iou, 6) AS iou FROM iou")
def f18_instance_overlaps(spark, sf_dir):
    return metrics.overlaps(_target(spark, sf_dir), _predicted(spark, sf_dir)).select("tile_id", "t", "p", "inter", r6("iou").alias("iou"))


def _counts(spark, sf_dir):
    return metrics.instance_counts(pixels(spark, sf_dir), _target(spark, sf_dir), _predicted(spark, sf_dir))


@query(f"{_PAIRS} SELECT tile_id, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall, round(coalesce(tp / nullif(tp + fp + fn, 0), 0.0), 6) AS accuracy, round(coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0.0), 6) AS fbeta FROM k")
def g10_g11_instance_metrics(spark, sf_dir):
    m = metrics.instance_metrics(_counts(spark, sf_dir))
    return m.withColumns({c: r6(c) for c in ("precision", "recall", "accuracy", "fbeta")})


@query(f"{_PAIRS} SELECT round(sum(tp) / sum(tp + fp + fn), 6) AS tp, round(sum(fp) / sum(tp + fp + fn), 6) AS fp, round(sum(fn) / sum(tp + fp + fn), 6) AS fn, 0.0::DOUBLE AS tn FROM k")
def g12_instance_confusion(spark, sf_dir):
    return metrics.instance_confusion(_counts(spark, sf_dir)).select(*(r6(c).alias(c) for c in ("tp", "fp", "fn", "tn")))


def _curve_part(v: float, k: int) -> str:
    cells = f"SELECT tile_id, y, x FROM pixels WHERE target <> 2 AND prob_b >= {v}"
    return (
        f"{_walk(f'q{k}', cells)}, i{k} AS (SELECT t.tile_id, t.region_id AS t, q.region_id AS p, count(*) AS n FROM t JOIN q{k} q ON q.tile_id = t.tile_id AND q.y = t.y AND q.x = t.x GROUP BY t.tile_id, t.region_id, q.region_id), "
        f"sp{k} AS (SELECT tile_id, region_id AS p, count(*) AS n FROM q{k} GROUP BY tile_id, region_id), k{k} AS (SELECT (SELECT count(*) FROM i{k} i JOIN st ON st.tile_id = i.tile_id AND st.t = i.t JOIN sp{k} sp ON sp.tile_id = i.tile_id AND sp.p = i.p WHERE i.n / (st.n + sp.n - i.n) >= 0.3) AS tp, (SELECT count(*) FROM sp{k}) AS np, (SELECT count(*) FROM st) AS nt)"
    )


_THRESHOLDS = (0.7, 0.8, 0.9)


_CURVE = (
    f"{_W}, {_walk('t', _T)}, st AS (SELECT tile_id, region_id AS t, count(*) AS n FROM t GROUP BY tile_id, region_id), "
    + ", ".join(_curve_part(v, k) for k, v in enumerate(_THRESHOLDS))
    + ", z AS ("
    + " UNION ALL ".join(f"SELECT CAST({v} AS DOUBLE) AS threshold, round(coalesce(tp / nullif(np, 0), 0.0), 6) AS precision, round(coalesce(tp / nullif(nt, 0), 0.0), 6) AS recall FROM k{k}" for k, v in enumerate(_THRESHOLDS))
    + ") "
)


@query(_CURVE + "SELECT round(sum((recall - before) * precision), 5) AS average_precision FROM (SELECT *, coalesce(lag(recall) OVER (ORDER BY threshold DESC), 0.0) AS before FROM z) y")
def g13_instance_average_precision(spark, sf_dir):
    c = metrics.instance_curve(pixels(spark, sf_dir), "target", "prob_b", _THRESHOLDS, matching=0.3)
    return metrics.instance_average_precision(c).withColumn("average_precision", r6("average_precision", 5))


@query(_CURVE + "SELECT * FROM z")
def g13_instance_curve(spark, sf_dir):
    c = metrics.instance_curve(pixels(spark, sf_dir), "target", "prob_b", _THRESHOLDS, matching=0.3)
    return c.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


_B = (
    "b AS (SELECT a.tile_id, a.y, a.x, a.t AND sum(CASE WHEN n.t THEN 1 ELSE 0 END) < 9 AS bt, a.p AND sum(CASE WHEN n.p THEN 1 ELSE 0 END) < 9 AS bp FROM m a JOIN m n ON n.tile_id = a.tile_id AND n.y BETWEEN a.y - 1 AND a.y + 1 AND n.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.tile_id, a.y, a.x, a.t, a.p, a.keep HAVING a.keep)"
)


@query(
    f"{_P}, m AS (SELECT tile_id, y, x, target <> 0 AND s2_scl <> 0 AS t, prob_a > 0.05 AND s2_scl <> 0 AS p, s2_scl <> 0 AS keep FROM pixels), {_B} SELECT tile_id, round(coalesce(sum(CASE WHEN bt AND bp THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN bt OR bp THEN 1 ELSE 0 END), 0), 0.0), 6) AS boundary_iou FROM b GROUP BY tile_id"
)
def g14_boundary_iou(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return metrics.boundary_iou(p, F.col("target") != 0, F.col("prob_a") > 0.05, F.col("s2_scl") != 0, WIDTH, HEIGHT, 1).withColumn("boundary_iou", r6("boundary_iou"))


def _outline(name: str, of: str, k: int = 1) -> str:
    return f"{name} AS (SELECT a.tile_id, a.region_id, a.y, a.x FROM {of} a JOIN {of} n ON n.tile_id = a.tile_id AND n.region_id = a.region_id AND n.y BETWEEN a.y - {k} AND a.y + {k} AND n.x BETWEEN a.x - {k} AND a.x + {k} GROUP BY a.tile_id, a.region_id, a.y, a.x HAVING count(*) < {(2 * k + 1) ** 2})"


@query(
    f"{_W}, {_walk('t', _T)}, {_walk('q', _PR)}, {_outline('ot', 't')}, {_outline('oq', 'q')}, i AS (SELECT t.tile_id, t.region_id AS t, q.region_id AS p, count(*) AS n FROM ot t JOIN oq q ON q.tile_id = t.tile_id AND q.y = t.y AND q.x = t.x GROUP BY t.tile_id, t.region_id, q.region_id) "
    "SELECT i.tile_id, i.t, i.p, round(i.n / (a.n + b.n - i.n), 6) AS iou FROM i JOIN (SELECT tile_id, region_id, count(*) AS n FROM ot GROUP BY tile_id, region_id) a ON a.tile_id = i.tile_id AND a.region_id = i.t JOIN (SELECT tile_id, region_id, count(*) AS n FROM oq GROUP BY tile_id, region_id) b ON b.tile_id = i.tile_id AND b.region_id = i.p"
)
def g15_instance_boundary_iou(spark, sf_dir):
    return metrics.instance_boundary_iou(_target(spark, sf_dir), _predicted(spark, sf_dir)).withColumn("iou", r6("iou"))


@query(
    f"{_P}, t AS (SELECT tile_id, y, x, 1 + x // 13 AS region_id FROM pixels WHERE prob_a >= 0.02), q AS (SELECT tile_id, y, x, 1 + (x + 3) // 13 AS region_id FROM pixels WHERE prob_b >= 0.02), {_outline('ot', 't', 2)}, {_outline('oq', 'q', 2)}, i AS (SELECT t.tile_id, t.region_id AS t, q.region_id AS p, count(*) AS n FROM ot t JOIN oq q ON q.tile_id = t.tile_id AND q.y = t.y AND q.x = t.x GROUP BY t.tile_id, t.region_id, q.region_id) "
    "SELECT i.tile_id, i.t, i.p, round(i.n / (a.n + b.n - i.n), 6) AS iou FROM i JOIN (SELECT tile_id, region_id, count(*) AS n FROM ot GROUP BY tile_id, region_id) a ON a.tile_id = i.tile_id AND a.region_id = i.t JOIN (SELECT tile_id, region_id, count(*) AS n FROM oq GROUP BY tile_id, region_id) b ON b.tile_id = i.tile_id AND b.region_id = i.p"
)
def g15_boundary_iou_by_diagonal(spark, sf_dir):
    """Outlines of large instances (bands of columns with gaps), as wide as a share of the diagonal: two cells."""
    p = pixels(spark, sf_dir)
    band = lambda x: (F.floor(x / 13) + 1).cast("int")
    t = p.where("prob_a >= 0.02").select(*CELL, band(F.col("x")).alias("region_id"))
    q = p.where("prob_b >= 0.02").select(*CELL, band(F.col("x") + 3).alias("region_id"))
    found = metrics.instance_boundary_iou(t, q, ratio=0.03, width=WIDTH, height=HEIGHT)
    return found.withColumn("iou", r6("iou"))


@query(f"{_W}, {_walk('t', _T)} SELECT t.tile_id, t.region_id, round(median(v), 6) AS median, round(median(v), 6) AS own_median, CAST(max(v) - min(v) AS DOUBLE) AS spread FROM t JOIN (SELECT tile_id, y, x, CAST(trunc(prob_a * 100) AS INT) AS v FROM pixels) p ON p.tile_id = t.tile_id AND p.y = t.y AND p.x = t.x GROUP BY t.tile_id, t.region_id")
def g1_user_statistics(spark, sf_dir):
    """Statistics by functions of the user, beside the built-in ones."""
    p = pixels(spark, sf_dir).withColumn("v", (F.col("prob_a") * 100).cast("int"))
    z = objects.zonal(_target(spark, sf_dir), p, "v", {"own_median": lambda v: v.median(), "spread": lambda v: v.max() - v.min()})
    return z.select("tile_id", "region_id", r6("median").alias("median"), r6("own_median").alias("own_median"), "spread")


@query(
    f"{_P}, k AS (SELECT tile_id, sum(CASE WHEN target = 1 AND prob_a > 0.5 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN target <> 1 AND prob_a > 0.5 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN target = 1 AND NOT prob_a > 0.5 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN target <> 1 AND NOT prob_a > 0.5 THEN 1 ELSE 0 END) AS tn FROM pixels WHERE target <> 2 GROUP BY tile_id), "
    "c AS (SELECT *, (tp + tn) / (tp + fp + fn + tn) AS acc, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS ch FROM k) "
    "SELECT tile_id, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, round(acc, 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(tn / nullif(tn + fp, 0), 6) AS specificity, "
    "round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round(tp / nullif(tp + fp + fn, 0), 6) AS jaccard, round((acc - ch) / (1 - ch), 6) + 0.0 AS kappa, round(1 - acc, 6) AS hamming FROM c"
)
def g7_pixel_metrics(spark, sf_dir):
    m = metrics.pixel_metrics(metrics.pixel_counts(pixels(spark, sf_dir), "target", F.col("prob_a") > 0.5, ["tile_id"]))
    return m.withColumns({c: r6(c) for c in ("accuracy", "precision", "recall", "specificity", "f1", "jaccard", "kappa", "hamming")})


_GRID = [k / 19 for k in range(20)]
_C = (
    f"{_P}, c AS (SELECT h.k, sum(CASE WHEN target = 1 AND prob_a >= h.k / 19 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN target <> 1 AND prob_a >= h.k / 19 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS pos, count(*) AS n FROM pixels CROSS JOIN range(0, 20) h(k) WHERE target <> 2 GROUP BY h.k)"
)


@query(f"{_C} SELECT round(k / 19, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(pos - tp AS BIGINT) AS fn, CAST(n - pos - fp AS BIGINT) AS tn FROM c")
def g8_curves(spark, sf_dir):
    return metrics.curve_counts(pixels(spark, sf_dir), "target", "prob_a", _GRID).withColumn("threshold", r6("threshold"))


@query(
    f"{_C}, r AS (SELECT k, tp / pos AS tpr, fp / (n - pos) AS fpr, coalesce(tp / nullif(tp + fp, 0), 1.0) AS pr FROM c), s AS (SELECT *, coalesce(lag(tpr) OVER (ORDER BY k DESC), 0.0) AS t0, coalesce(lag(fpr) OVER (ORDER BY k DESC), 0.0) AS f0 FROM r) "
    "SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS auroc, round(sum((tpr - t0) * pr), 6) AS average_precision FROM s"
)
def g8_areas(spark, sf_dir):
    a = metrics.areas(metrics.curve_counts(pixels(spark, sf_dir), "target", "prob_a", _GRID))
    return a.select(r6("auroc").alias("auroc"), r6("average_precision").alias("average_precision"))


@query(f"{_P} SELECT target, predicted, n, round(n / sum(n) OVER (PARTITION BY target), 6) AS share FROM (SELECT target, CASE WHEN prob_a > 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM pixels WHERE target <> 2 GROUP BY 1, 2) c")
def g9_confusion_matrix(spark, sf_dir):
    return metrics.confusion(pixels(spark, sf_dir), "target", F.col("prob_a") > 0.5).withColumn("share", r6("share"))
