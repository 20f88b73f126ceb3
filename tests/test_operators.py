"""Golden fixtures, invariants and edge cases of the raster and catalogue operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.functions.graph import components
from tesserae.functions import storage
from tesserae.operators import bands, catalog, codecs, coreg, focal, geometry, indices, metrics, objects, patches, polygons, runs, splits, volume
from tesserae.sources import products
from tesserae.streaming import ingest


def grid(spark, values, name="v", tile=0):
    a = np.asarray(values)
    rows = [(tile, int(y), int(x), a[y, x].item()) for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, ["tile_id", "y", "x", name]).select(F.col("tile_id").cast("int"), F.col("y").cast("int"), F.col("x").cast("int"), name)


def back(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.select("y", "x", F.col(name).cast("double").alias("v")).collect():
        out[r["y"], r["x"]] = np.nan if r["v"] is None else r["v"]
    return out


def blurred(blocks, n):
    a = np.zeros((n, n), np.int8)
    for y0, y1, x0, x1 in blocks:
        a[y0:y1, x0:x1] = 100
    k = np.exp(-0.5 * (np.arange(-8, 9) / 2.0) ** 2)
    k /= k.sum()
    out = a
    for axis in (0, 1):
        padded = np.pad(out.astype(float), [(8, 8) if i == axis else (0, 0) for i in (0, 1)], mode="symmetric")
        out = np.apply_along_axis(lambda v: np.convolve(v, k, mode="valid"), axis, padded).astype(np.int8)
    return (out * (100.0 / out.max())).astype(np.int8).astype(int)


def test_zonal_statistics_of_a_blurred_block(spark):
    p = blurred([(5, 9, 8, 10)], 16)
    df = grid(spark, p).withColumn("m", F.col("v") > 50)
    labels = objects.label(df, "m")
    got = objects.zonal(labels, df, "v").collect()
    assert len(got) == 1
    r = got[0]
    assert (r["min"], r["max"], r["mean"], r["median"], r["npixel"]) == (56, 100, 76.0, 76.0, 20)
    assert round(r["std"], 5) == 15.38831
    rings = objects.polygons(labels).collect()
    assert len(rings) == 1 and len(rings[0]["ring"]) == 13 and rings[0]["ring"][0] == rings[0]["ring"][-1]


def flood(mask, diagonal=True):
    label, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask)):
        if label[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        while todo:
            a, b = todo.pop()
            if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not label[a, b]:
                label[a, b] = n
                todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if diagonal or not i * j]
    return label


@pytest.mark.parametrize("diagonal", [True, False])
def test_components_in_raster_order(spark, diagonal):
    rng = np.random.default_rng(3)
    m = rng.random((25, 90)) < 0.45
    got = back(objects.label(grid(spark, m, "m"), "m", 8 if diagonal else 4), "region_id", m.shape)
    assert np.array_equal(np.nan_to_num(got).astype(int), flood(m, diagonal))


def test_graph_components_of_a_long_path(spark):
    rnd = random.Random(4)
    names = list(range(300))
    rnd.shuffle(names)
    edges = list(zip(names, names[1:])) + [(1000, 1001), (5000, 5000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(300)} | {1000: 1000, 1001: 1000}


def test_erosion_and_boundary_squares(spark):
    m = np.zeros((100, 100), bool)
    m[11:42, 11:43] = True
    want = np.zeros_like(m)
    want[12:41, 12:42] = True
    assert np.array_equal(back(focal.erode_square(grid(spark, m, "m"), "m"), "eroded", m.shape).astype(bool), want)
    m[:] = False
    m[10:50, 10:50] = True
    want = m.copy()
    want[13:47, 13:47] = False
    assert np.array_equal(back(focal.boundary(grid(spark, m, "m"), "m", 100, 100, 0.02), "boundary", m.shape).astype(bool), want)


def test_terrain_on_a_plane(spark):
    y, x = np.mgrid[0:8, 0:9]
    got = focal.terrain(grid(spark, (x * 10.0), "dem"))
    slope = back(got, "slope", (8, 9))
    assert np.allclose(slope[1:-1, 1:-1], 45.0) and np.isnan(slope[0]).all()
    assert np.allclose(back(got, "curvature", (8, 9))[1:-1, 1:-1], 0)
    flat = focal.terrain(grid(spark, y * 0.0, "dem"))
    assert (back(flat, "aspect", (8, 9))[1:-1, 1:-1] == -1).all()


def test_patch_origins_golden_and_blending_identity(spark):
    tiles = spark.createDataFrame([(0, 60, 60)], "tile_id int, height int, width int")
    got = [(r["y0"], r["x0"]) for r in patches.origins(tiles, 8, 3).orderBy("patch_id").limit(20).collect()]
    assert got[:13] == [(0, x) for x in [*range(0, 51, 5), 52]] + [(5, 0)]
    for size, patch, overlap in ((23, 8, 3), (60, 8, 1), (10, 8, 0), (23, 8, 0)):
        t = spark.createDataFrame([(0, size, size)], "tile_id int, height int, width int")
        o = patches.origins(t, patch, overlap)
        assert o.count() == math.ceil((size - overlap) / (patch - overlap)) ** 2
        rng = np.random.default_rng(size)
        v = rng.random((size, size))
        cells = patches.cut(grid(spark, v), o, patch).withColumn("p", patches.logistic({"v": 2.0}, 0.0))
        blended = back(patches.blend(cells, patch, overlap), "p", v.shape)
        want = 1 / (1 + np.exp(-2 * v))
        inside = blended > 0  # where every covering patch has weight 0, the blend is 0
        assert np.allclose(blended[inside], want[inside]) and (overlap or inside.all())


def test_codec_round_trip_and_faults(spark):
    red = codecs.lookup("red")
    df = spark.createDataFrame([(v,) for v in (-0.1, -0.05, 0.0, 0.123456, 0.5, None)], "v double")
    got = df.withColumn("e", codecs.encode(F.col("v"), red)).withColumn("d", codecs.decode(F.col("e"), red)).withColumn("n", codecs.normalise(F.col("v"), red)).collect()
    for r in got[1:-1]:
        assert abs(r["d"] - r["v"]) <= 0.5e-4 + 1e-12 and 0 <= r["n"] <= 1
    assert got[-1]["e"] == 0 and got[-1]["d"] is None and got[-1]["n"] == 0
    assert codecs.faults(codecs.as_table(spark)).count() == 0
    with pytest.raises(ValueError):
        codecs.normalise(F.col("v"), codecs.lookup("unknown"))


def test_indices_with_zero_denominators(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (0.1, 0.2, 0.1, 0.4)], "blue double, green double, red double, nir double")
    a, b = indices.add_indices(df, ["ndvi", "gli", "rvi", "tvi"]).orderBy("nir").collect()
    assert a["ndvi"] is None and a["gli"] is None and a["rvi"] is None
    assert math.isclose(b["ndvi"], 0.6) and math.isclose(b["rvi"], 0.25) and math.isclose(b["gli"], 0.2 / 0.6)
    with pytest.raises(ValueError):
        indices.named_index(df, "k", "c * 2", {"c": 1.0})


def test_quality_masks(spark):
    df = spark.createDataFrame([(k,) for k in [None, *range(12)]], "scl int")
    got = [r[0] for r in df.select(bands.quality_from_scl(F.col("scl"))).collect()]
    assert got == [0, 0, 0, 2, 1, 2, 2, 2, 2, 1, 1, 2, 1]


def test_run_scores_golden(spark):
    rows = [(1, 0.9, 0.8, 0.5), (1, 0.7, 0.6, 0.4), (2, 0.0, 0.9, 0.3), (2, float("inf"), 0.9, 0.3)]
    df = spark.createDataFrame(rows, "run int, iou double, recall double, loss double")
    h = {r["run"]: r for r in runs.group_score(df, ["iou", "recall"], "harmonic").collect()}
    assert math.isclose(h[1]["score"], (2 / (1 / 0.9 + 1 / 0.8) + 2 / (1 / 0.7 + 1 / 0.6)) / 2) and h[2]["score"] == 0 and h[2]["is_unstable"]
    low = {r["run"]: r["score"] for r in runs.group_score(df.where("run = 1"), ["iou", "loss:lower"], "min").collect()}
    assert math.isclose(low[1], 0.8)
    assert runs.best(runs.group_score(df, ["iou", "recall"], "harmonic")).first()["run"] == 1


def test_instance_counts_special_cases(spark):
    t = grid(spark, [[1, 1, 0, 0], [0, 0, 0, 0]], "m")
    none = grid(spark, np.zeros((2, 4), int), "m")
    on = lambda df: objects.label(df.withColumn("b", F.col("m") == 1), "b")
    count = lambda a, b: tuple(metrics.instance_counts(t, on(a), on(b)).select("tp", "fp", "fn").first())
    assert count(t, t) == (1, 0, 0) and count(t, none) == (0, 0, 1) and count(none, t) == (0, 1, 0) and count(none, none) == (0, 0, 0)


def test_splits_and_folds(spark):
    meta = spark.range(103).withColumns({"g": F.col("id") % 7, "is_empty": F.col("id") % 3 == 0})
    sizes = [r["count"] for r in splits.contiguous_folds(meta, "id", 5).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [21, 21, 21, 20, 20]
    s = splits.split_random(meta, "id", 0.7, ~F.col("is_empty"))
    assert {r["part"]: r["count"] for r in s.groupBy("part").count().collect()} == {"train": 72, "test": 31}
    assert splits.group_folds(meta, "g", 3).groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert splits.stratified_folds(meta, "id", "g", 5).groupBy("g", "fold").count().agg(F.max("count") - F.min("count")).first()[0] <= 1
    dealt = splits.group_folds(meta, "g", 3, stratum=~F.col("is_empty")).groupBy("fold").agg(F.count_distinct("g").alias("g"), F.count_if(~F.col("is_empty")).alias("n")).collect()
    assert sorted(r["g"] for r in dealt) == [2, 2, 3] and sum(r["n"] for r in dealt) == 68
    parts = splits.split_by_value(meta, "g", [1])
    some = splits.subsample(parts, "id", 40)
    ids = {r["id"] for r in some.collect()}
    assert len(ids) == 40 == some.count() and some.columns == parts.columns
    assert ids == {r["id"] for r in splits.subsample(parts.repartition(7), "id", 40).collect()} < {r["id"] for r in splits.subsample(parts, "id", 41).collect()}
    assert splits.subsample(parts, "id", 500).count() == 103 and splits.subsample(parts, "id", 0).count() == 0 and splits.subsample(parts.limit(0), "id", 5).count() == 0
    assert splits.no_split(meta).count() == 206
    with pytest.raises(ValueError):
        splits.select_bands(meta, ["id"], ["none"])


def test_grid_rows_follow_the_construction(spark):
    d = 500
    n = math.ceil(math.pi * 6378.137 / d)
    got = geometry.grid_rows(spark, d).orderBy("row").collect()
    assert len(got) == n and got[0]["lat"] == -90 and all(-90 <= r["lat"] < 90 for r in got)
    cells = geometry.grid_cells(geometry.grid_rows(spark, d))
    index = cells.select("row", "col", *(c.alias(k) for c, k in zip(geometry.grid_index(F.col("name")), ("r", "c"))))
    assert index.where("row <> r OR col <> c OR r IS NULL").count() == 0
    assert cells.where("lon < -180 OR lon > 180").count() == 0


def test_utm_against_known_points(spark):
    df = spark.createDataFrame([(48.8582, 2.2945, 448251.9, 5411943.8), (-33.8568, 151.2153, 334897.4, 6252294.8)], "lat double, lon double, e double, n double")
    zone = geometry.utm_zone(F.col("lat"), F.col("lon"))
    east, north = geometry.to_utm(F.col("lat"), F.col("lon"), zone)
    for r in df.select(zone.alias("z"), east.alias("x"), north.alias("y"), "e", "n").collect():
        assert r["z"] in (32631, 32756)
        assert abs(r["x"] - r["e"]) < 60 and abs(r["y"] - r["n"]) < 60
    special = spark.createDataFrame([(60.0, 5.0, 32632), (78.0, 8.0, 32631), (78.0, 10.0, 32633), (78.0, 25.0, 32635), (78.0, 40.0, 32637), (0.0, 180.0, 32660)], "lat double, lon double, z int")
    assert special.where(geometry.utm_zone(F.col("lat"), F.col("lon")) != F.col("z")).count() == 0


def test_ring_validity_and_area(spark):
    df = spark.range(1)
    box = geometry.box_ring(F.lit(0), F.lit(0), F.lit(3), F.lit(2))
    bow = F.array(*(F.element_at(box, k) for k in (1, 2, 4, 3, 1)))
    got = df.select(polygons.valid(box).alias("a"), polygons.valid(bow).alias("b"), polygons.valid(F.slice(box, 1, 4)).alias("c"), geometry.area(box).alias("d")).first()
    assert tuple(got) == (True, False, False, 6.0)


def test_scene_matching_with_a_tie(spark):
    f = spark.createDataFrame([(1, 0, 0, 10, 10), (2, 500, 500, 510, 510)], "image_id long, xmin int, ymin int, xmax int, ymax int").withColumn("ts", F.lit("2024-01-05").cast("timestamp"))
    s = spark.createDataFrame([(8, 0, 0, 20, 20, 5), (7, 0, 0, 20, 20, 5), (6, 0, 0, 6, 10, 0)], "scene_id long, xmin int, ymin int, xmax int, ymax int, cloud int").withColumn("ts", F.lit("2024-01-06").cast("timestamp"))
    got = {r["image_id"]: r["scene_id"] for r in catalog.match_scenes(f, s).collect()}
    assert got == {1: 7, 2: None}


def test_known_shift_is_recovered(spark):
    rng = np.random.default_rng(5)
    a = rng.random((24, 24))
    df = grid(spark, a)
    moved = df.select("tile_id", (F.col("y") + 2).alias("y"), (F.col("x") - 3).alias("x"), "v")
    r = coreg.peak(coreg.score_surface(df, moved, "v", 5)).first()
    assert abs(r["x_offset"] + 3) < 0.5 and abs(r["y_offset"] - 2) < 0.5 and 0 < r["shift_reliability"] <= 100


def test_offsets_take_the_target_near_the_window_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    a = rng.random((40, 60))
    df = grid(spark, a).withColumns({"w": F.col("v") * 2, "usable": F.lit(True)})
    moved = df.select("tile_id", (F.col("y") + 2).alias("y"), (F.col("x") - 1).alias("x"), "v", "w", "usable")
    given, whole, judged, alike = [], coreg.score_surface, [], coreg.similarity
    monkeypatch.setattr(coreg, "score_surface", lambda own, other, *args: given.append((own, other)) or whole(own, other, *args))
    monkeypatch.setattr(coreg, "similarity", lambda pairs, *args, **more: judged.append(pairs) or alike(pairs, *args, **more))
    got = coreg.band_offsets(df, moved, ("v", "w"), 60, 40, size=11, most=3).collect()
    own, other = given[0]
    assert own.count() == 2 * 11 * 11 and other.count() == 2 * 17 * 17
    assert len(judged) == 1 and judged[0].count() == 2 * 2 * 11 * 11
    window = coreg.valid_window(df, 60, 40, 11, F.col("usable"))
    here = coreg.in_window(df, window).select("tile_id", "y", "x", F.col("v").alias("a"))
    before = alike(here.join(moved.select("tile_id", "y", "x", F.col("v").alias("b")), ["tile_id", "y", "x"]), "a", "b").first()["ssim"]
    assert sorted((r["band"], round(r["x_offset"]), round(r["y_offset"])) for r in got) == [("v", -1, 2), ("w", -1, 2)]
    assert all(abs(r["ssim_before"] - before) < 1e-9 and abs(r["ssim_after"] - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("block", [5, 128])
def test_scores_of_all_shifts_with_gaps(spark, block):
    rng = np.random.default_rng(7)
    a, b = rng.random((9, 12)), rng.random((14, 16))
    a[rng.random(a.shape) < 0.2] = b[rng.random(b.shape) < 0.2] = np.nan
    cells = lambda v, y0, x0: grid(spark, v).select("tile_id", (F.col("y") + y0).alias("y"), (F.col("x") + x0).alias("x"), "v")
    got = {(r["sx"], r["sy"]): r["score"] for r in coreg.score_surface(cells(a, 0, 0), cells(b, -3, 2), "v", 4, block=block).collect()}
    for sy in range(-4, 5):
        for sx in range(-4, 5):
            both = [(a[y, x], b[y + sy + 3, x + sx - 2]) for y in range(9) for x in range(12) if 0 <= y + sy + 3 < 14 and 0 <= x + sx - 2 < 16]
            r, t = np.array([p for p in both if np.isfinite(p).all()]).T
            assert abs(got[sx, sy] - np.corrcoef(r, t)[0, 1]) < 1e-9


def test_both_training_tables_come_from_one_pass(spark):
    cells = spark.createDataFrame([(1, p, y, x, None if x == y else float(p + 10 * y + x), p + x) for p in (0, 1, 2) for y in (1, 0) for x in (0, 1)], "tile_id int, patch_id int, dy int, dx int, v double, label int")
    kept = spark.createDataFrame([(5, 1, 0), (6, 1, 2)], "z_idx long, tile_id int, patch_id int")
    stored = storage.cut(products.patch_values(cells.withColumn("w", -F.col("v")), kept, ["v", "w"], "label", 2))
    for x, y in (products.split_values(stored, ["v", "w"]), products.training_tables(cells.withColumn("w", -F.col("v")), kept, ["v", "w"], "label", 2)):
        assert sorted(tuple(r) for r in x.collect()) == [(5, "v", [0.0, 1.0, 10.0, 0.0]), (5, "w", [0.0, -1.0, -10.0, 0.0]), (6, "v", [0.0, 3.0, 12.0, 0.0]), (6, "w", [0.0, -3.0, -12.0, 0.0])]
        assert sorted(tuple(r) for r in y.collect()) == [(5, [0, 1, 0, 1]), (6, [2, 3, 2, 3])]
    assert not any(word in plan_of(df) for df in products.split_values(stored, ["v", "w"]) for word in ("Join", "Exchange"))


def test_products_and_ledger(spark, tmp_path):
    df = grid(spark, np.arange(12).reshape(3, 4) / 12, "probabilities")
    with pytest.raises(ValueError):
        products.route(df, ["optical"])
    products.write_products(products.route(df, ["probabilities"]), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 12

    def work(rows):
        raise RuntimeError("lost")

    r = products.with_ledger(df, work).first()
    assert r["status"] == "failed" and r["error"] == "RuntimeError: lost"


def test_stream_handles_each_scene_once(spark, tmp_path):
    schema = spark.createDataFrame([(1, 2.0)], "scene_id long, v double").schema
    spark.createDataFrame([(1, 1.0), (2, 2.0)], schema).write.parquet(f"{tmp_path}/in")
    go = lambda: ingest.ingest(ingest.scene_stream(spark, f"{tmp_path}/in", schema), lambda d: d, f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/state")
    go()
    spark.createDataFrame([(2, 2.0), (3, 3.0)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    go()
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("scene_id").collect()) == [1, 2, 3]


def test_volume_thresholds_are_cumulative(spark):
    s = spark.createDataFrame([(2020, 5, 3), (2020, 5, 30), (2020, 6, 100)], "year int, month int, cloud int")
    got = {(r["month"], r["threshold"]): r["n"] for r in volume.under_cloud(s, [10, 50, 100]).collect()}
    assert got == {(5, 10): 1, (5, 50): 2, (5, 100): 2, (6, 10): 0, (6, 50): 0, (6, 100): 1}


def test_tiles_with_names(spark):
    a = np.zeros((6, 8), int)
    a[1:3, 1:3] = a[4, 6] = 1
    df = grid(spark, a).withColumn("tile_id", F.lit("T32VXK")).withColumn("m", F.col("v") == 1)
    rows = objects.vectorise(df, "m", "v").orderBy("region_id").collect()
    assert [(r["tile_id"], r["region_id"], r["npixel"], len(r["ring"])) for r in rows] == [("T32VXK", 1, 4, 5), ("T32VXK", 2, 1, 5)]
    assert back(objects.remove_small(df, "m", 2), "m", a.shape).sum() == 4


def test_rings_of_holes_and_touching_corners(spark):
    a = np.zeros((9, 9), int)
    a[1:7, 1:7] = 1
    a[2:4, 2:4] = a[4, 4] = 0  # holes that touch at a corner
    a[7, 7] = 1  # touches the block at a corner
    df = grid(spark, a).withColumn("m", F.col("v") == 1)
    rings = [[(p["x"], p["y"]) for p in r["ring"]] for r in objects.polygons(objects.label(df, "m")).collect()]
    area = lambda r: sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:])) / 2
    assert sum(map(area, rings)) == a.sum() and all(r[0] == r[-1] and len(set(r)) >= 4 for r in rings)
    assert sorted(map(area, rings)) == [-5, 1, 36]
    assert all((p[0] == q[0]) != (p[1] == q[1]) for r in rings for p, q in zip(r, r[1:]))


def test_polygon_products_by_subset(spark):
    a = np.zeros((5, 5), int)
    a[1:3, 1:3] = 60
    df = grid(spark, a, "p").withColumns({"m1": F.col("p") > 50, "m2": F.col("p") >= 0, "extent": F.lit(True)})
    rows = objects.polygon_products(df, {"all": ("m1", "p"), "wide": ("m2", "p")}, "extent").collect()
    assert sorted((r["product"], r["subset"], r["npixel"]) for r in rows) == [("extent", "", 25), ("segments", "all", 4), ("segments", "wide", 25)]


def test_one_to_one_matching(spark):
    pairs = spark.createDataFrame([(0, 1, 1, 0.4), (0, 1, 2, 0.35), (0, 2, 2, 0.3), (0, 2, 1, 0.39)], "tile_id int, t int, p int, iou double")
    assert {(r["t"], r["p"]) for r in metrics.one_to_one(pairs).collect()} == {(1, 1), (2, 2)}


def test_stored_and_new_coordinates_must_agree(spark):
    old = spark.createDataFrame([(1, 10.0, 5)], "k int, x0 double, red int")
    good = spark.createDataFrame([(1, 10.0, 6), (2, 20.0, 7)], "k int, x0 double, nir int")
    rows = catalog.upsert_bands(old, good, ["k"], ["red", "nir"], ["x0"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 10.0, 5, 6), (2, 20.0, None, 7)]
    with pytest.raises(Exception, match="x0 of the new bands"):
        catalog.upsert_bands(old, good.withColumn("x0", F.col("x0") + 1), ["k"], ["red", "nir"], ["x0"]).collect()


def test_ledger_by_blocks(spark):
    df = grid(spark, np.arange(16).reshape(4, 4))

    def work(rows):
        if rows["v"].max() == 15:
            raise ValueError("last block")
        return f"/out/{rows['y'].min()}"

    assert [tuple(r) for r in products.with_ledger(df, work, block=2).collect()] == [(0, None, "failed", "ValueError: last block")]
    assert [tuple(r) for r in products.with_ledger(df.where("v < 15"), work, block=2).collect()] == [(0, "/out/0", "success", None)]


def test_registered_indices(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.3, 0.6), (None, 0.0, 0.0, 0.0)], "blue double, green double, red double, nir double")
    first, second = indices.registered_index(indices.registered_index(df, "EVI"), "SAVI", L=0.0).collect()
    assert first["evi"] == pytest.approx(2.5 * 0.3 / (0.6 + 6 * 0.3 - 7.5 * 0.1 + 1)) and first["savi"] == pytest.approx(0.3 / 0.9)
    assert second["evi"] is None and second["savi"] is None
    own = indices.registry_table(spark, [("Mine", "(n - r) / (n + r + r_)", {"r_": 1.0})])
    assert indices.registered_index(df, "Mine", own, n=F.col("nir"), r=F.col("red")).first()["mine"] == pytest.approx(0.3 / 1.9)
    with pytest.raises(ValueError):
        indices.registered_index(df, "DVI", N=1.0, R=0.5)
    with pytest.raises(ValueError):
        indices.registered_index(df, "nothing")


def test_codec_names(spark):
    names = spark.createDataFrame([("s2-scl",), ("tcXwetness",), ("probabilities-a_b",), ("hillshade",)], "name string")
    got = dict(map(tuple, codecs.lookup_table(names, codecs.as_table(spark)).collect()))
    assert got == {"s2-scl": None, "tcXwetness": None, "probabilities-a_b": "probabilities-*", "hillshade": "hillshade"}


def test_window_search_ends_at_the_border(spark):
    a = np.zeros((7, 9), int)
    a[0:3, 0:3] = 1  # a good window that the spiral would reach only after leaving the tile
    a[4:7, 5:8] = 1
    row = coreg.valid_window(grid(spark, a), 9, 7, 3, F.col("v") == 1).first()
    assert (row["step"], row["y0"], row["x0"], row["rows"], row["cols"]) in [(None, 0, 0, 7, 9), (12, 4, 5, 3, 3)]
    whole = coreg.valid_window(grid(spark, np.zeros((7, 9), int)), 9, 7, 3, F.col("v") == 1).first()
    assert (whole["step"], whole["rows"], whole["cols"]) == (None, 7, 9)


def test_a_scene_twice_in_a_batch(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "scene_id string, v int").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    ingest.ingest(ingest.scene_stream(spark, f"{tmp_path}/in", schema), lambda rows: rows, f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/state")
    assert sorted(r["scene_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]


def test_assembling_features_checks_grids(spark):
    grid = spark.createDataFrame([(1, None, 0.0, 0.0, 10.0, -10.0, 2, 2), (2, "a", 20.0, 0.0, 10.0, -10.0, 2, 2)], "tile_id int, crs string, x0 double, y0 double, res_x double, res_y double, width int, height int")
    base = spark.createDataFrame([(t, y, x, 0.5) for t in (1, 2) for y in (0, 1) for x in (0, 1)], "tile_id int, y int, x int, red double")
    dem = base.where("tile_id = 1 AND x = 0").withColumnRenamed("red", "dem")
    trend = base.where("y = 0").select("tile_id", "y", "x", F.lit(7).alias("trend"))
    got = geometry.assemble(base, grid, [(dem, grid.where("tile_id = 1")), (trend, grid)], {"trend": 0})
    assert got.columns == ["tile_id", "y", "x", "red", "dem", "trend"] and got.count() == 8
    assert got.where("dem IS NULL").count() == 6 and got.agg(F.sum("trend")).first()[0] == 28 and got.where("trend IS NULL").count() == 0
    assert geometry.assemble(base, grid, []).count() == 8
    for column, value in (("x0", F.lit(5.0)), ("crs", F.lit("b")), ("width", F.lit(None).cast("int"))):
        with pytest.raises(ValueError, match="another grid"):
            geometry.assemble(base, grid, [(dem, grid.withColumn(column, value))])
    with pytest.raises(ValueError, match="several layers"):
        geometry.assemble(base, grid, [(dem, grid), (dem, grid)])


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def some_tiles(spark, n=3, height=30, width=50):
    cells = spark.range(n).selectExpr("cast(id as int) AS tile_id").withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    return cells.withColumn("v", F.col("tile_id") * 10000 + F.col("y") * 100 + F.col("x"))


@pytest.mark.parametrize("size, overlap", [(16, 4), (7, 6), (5, 0)])
def test_patches_are_cut_without_a_broadcast(spark, size, overlap):
    tiles = some_tiles(spark, 2, 18, 21)
    o = patches.origins(tiles.select("tile_id").distinct().withColumns({"height": F.lit(18), "width": F.lit(21)}), size, overlap)
    cells = patches.cut(tiles, o, size)
    assert "BroadcastExchange" not in plan_of(cells)
    want = {(r["tile_id"], r["patch_id"], r["y0"] + dy, r["x0"] + dx, dy, dx, r["tile_id"] * 10000 + (r["y0"] + dy) * 100 + r["x0"] + dx) for r in o.collect() for dy in range(size) for dx in range(size)}
    got = [tuple(r) for r in cells.select("tile_id", "patch_id", "y", "x", "dy", "dx", "v").collect()]
    assert len(got) == len(want) and set(got) == want


def test_patches_are_scored_in_groups_of_several(spark):
    tiles = some_tiles(spark, 3, 18, 21).withColumn("v", F.when(F.col("tile_id") != 2, F.col("v")))
    o = patches.origins(tiles.select("tile_id").distinct().withColumns({"height": F.lit(18), "width": F.lit(21)}), 8, 3)
    scored = patches.score_patches(patches.cut(tiles, o, 8), ["v"], lambda a: a[0] - a[0].min(), 8)
    assert "FlatMapGroupsInPandas" not in plan_of(scored)
    got = {tuple(r) for r in scored.select("tile_id", "patch_id", "dy", "dx", "p").collect()}
    assert got == {(r["tile_id"], r["patch_id"], dy, dx, 0.0 if r["tile_id"] == 2 else 100.0 * dy + dx) for r in o.collect() for dy in range(8) for dx in range(8)}


@pytest.mark.parametrize("pad", [3, 11])
def test_padding_needs_no_join(spark, pad):
    v = np.arange(24).reshape(4, 6)
    padded = patches.pad_reflect(grid(spark, v), pad, 6, 4)
    assert "Join" not in plan_of(padded)
    got = [tuple(r) for r in padded.select("y", "x", "v").collect()]
    want = np.pad(v, pad, mode="reflect")
    assert len(got) == want.size and all(want[y + pad, x + pad] == n for y, x, n in got)


def test_training_rows_are_joined_without_a_broadcast_of_patches(spark):
    tiles = some_tiles(spark, 2, 18, 21).withColumn("label", F.col("x") % 2)
    o = patches.origins(tiles.select("tile_id").distinct().withColumns({"height": F.lit(18), "width": F.lit(21)}), 8, 3)
    cells = patches.cut(tiles, o, 8)
    samples = spark.createDataFrame([(0, 5, 50)], "tile_id int, region int, sample_id int")
    meta = patches.patch_metadata(patches.training_patches(cells, ["v"], "label", 8), o, samples=samples)
    x, y = products.training_tables(cells, meta, ["v"], "label", 8)
    # the ranges of the running numbers are a table of bounded size: one broadcast in each
    assert [plan_of(df).split("== Initial Plan ==")[0].count("BroadcastHashJoin") for df in (meta, x, y)] == [1, 1, 1]
    assert meta.count() == o.count() == y.count() and {r["region"] for r in meta.collect()} == {5, None}


@pytest.mark.parametrize("rings", [False, True])
def test_copies_of_footprints_and_scenes_are_matched_once(spark, rings, monkeypatch):
    f = spark.range(200).selectExpr("id AS image_id", "0 AS xmin", "0 AS ymin", "10 AS xmax", "10 AS ymax", "timestamp '2024-01-05' + make_dt_interval(cast(id % 2 as int)) AS ts", "id % 2 AS period")
    s = spark.range(300).selectExpr("id + 1000 AS scene_id", "0 AS xmin", "0 AS ymin", "8 + cast(id % 3 as int) AS xmax", "10 AS ymax", "timestamp '2024-01-05' + make_dt_interval(cast(id % 4 as int)) AS ts", "5 AS cloud", "id % 2 AS period")
    if rings:
        f, s = (df.withColumn("ring", geometry.box_ring(*(F.col(c) for c in catalog.BOX))) for df in (f, s))
    made, whole = [], catalog.candidates

    def counted(*args):
        made.append(whole(*args))
        return made[-1]

    monkeypatch.setattr(catalog, "candidates", counted)
    got = {r["image_id"]: r["scene_id"] for r in catalog.match_scenes(f, s).collect()}
    assert got == {i: 1000 + next(k for k in range(300) if k % 3 == 2 and k % 4 == i % 2) for i in range(200)}
    got = {r["image_id"]: r["scene_id"] for r in catalog.match_mosaics(f, s, ["period"]).collect()}
    assert got == {i: 1000 + next(k for k in range(300) if k % 3 == 2 and k % 2 == i % 2) for i in range(200)}
    assert [df.count() <= 2 * 12 for df in made] == [True, True]  # 2 kinds of footprints, 12 of scenes
    assert {(r["image_id"], r["n"]) for r in catalog.count_candidates(f, s).collect()} == {(i, 300) for i in range(200)}
    assert made[2].count() == 3  # a row for each kind of scene
    assert [df.count() for df in (catalog.scenes_for_areas(s, f), catalog.scenes_for_areas(s, f.where("false")))] == [300, 0]


def test_cells_are_resampled_and_measured_without_a_broadcast(spark):
    tiles = some_tiles(spark, 2, 6, 6).withColumn("m", (F.col("x") + F.col("y")) % 2 == 0)
    cells = tiles.select("tile_id", "y", "x")
    for cubic in (False, True):
        assert "BroadcastHashJoin" not in plan_of(geometry.resample(tiles.drop("m"), cells, "v", 1.0, 0.0, 0.0, cubic=cubic))
    found = objects.label(tiles, "m")
    assert "BroadcastHashJoin" not in plan_of(objects.zonal(found, tiles, "v"))
    assert "BroadcastHashJoin" not in plan_of(objects.vectorise(tiles, "m", "v"))


def test_equal_polygons_are_walked_once(spark, monkeypatch):
    tiles = some_tiles(spark, 1, 6, 6).withColumns({"extent": F.lit(True), "quality": F.lit(2)})
    labels = spark.range(50).select(F.lit(0).alias("tile_id"), geometry.box_ring(F.lit(1), F.lit(1), F.lit(4), F.lit(3) + F.col("id") % 2).alias("ring"))
    walked, whole = [], geometry.polygon_runs
    monkeypatch.setattr(geometry, "polygon_runs", lambda df: walked.append(df) or whole(df))
    got = {(r["y"], r["x"]) for r in geometry.rasterise(tiles, labels, "extent", "quality").where("label = 1").collect()}
    assert got == {(y, x) for y in range(1, 4) for x in range(1, 4)}
    assert walked[0].count() == 2
