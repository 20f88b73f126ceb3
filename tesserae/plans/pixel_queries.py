"""Queries over single pixels: decoding, quality, codecs, indices, products."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import bands, codecs, focal, indices, patches
from tesserae.plans.base import CELL, DECODED, decoded, pixels, query, r6, rounded
from tesserae.sources import products
from tesserae.sources.adapters import cte, table

_P = cte("pixels")


@query(f"{DECODED} SELECT tile_id, y, x, round(blue, 6) AS blue, round(green, 6) AS green, round(red, 6) AS red, round(nir, 6) AS nir, quality FROM decoded")
def a1_b14a_load_scene(spark, sf_dir):
    return rounded(decoded(spark, sf_dir), bands.OPTICAL).select(*CELL, *bands.OPTICAL, "quality")


@query(f"{_P} SELECT tile_id, y, x, dem FROM pixels WHERE x BETWEEN 10 - 5 AND 29 + 5 AND y BETWEEN 8 - 5 AND 21 + 5")
def a2_load_terrain_with_buffer(spark, sf_dir):
    """Every tile's terrain in a box of cells and in the buffer that focal steps of 30 metres need about it."""
    return focal.halo(pixels(spark, sf_dir).select(*CELL, "dem"), (10, 8, 30, 22), focal.buffer_cells(30, 10))


@query(f"{_P} SELECT tile_id, y, x, red_dn AS red, nir_dn AS nir, s2_scl FROM pixels")
def a5_rename_bands(spark, sf_dir):
    p = pixels(spark, sf_dir).select(*CELL, "blue_dn", "green_dn", "red_dn", "nir_dn", "s2_scl")
    names = {"blue_dn": "blue", "green_dn": "green", "red_dn": "red", "nir_dn": "nir"}
    return bands.rename_bands(p, names, ["red", "nir"], "s2_scl")


@query(f"{_P} SELECT tile_id, y, x, coalesce(CAST(trunc(CASE WHEN s2_scl <> 0 THEN prob_a END * 100) AS INT), 255) AS percent FROM pixels")
def a12_probability_product(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return p.select(*CELL, products.probability_product(F.when(F.col("s2_scl") != 0, F.col("prob_a"))).alias("percent"))


@query(f"{_P} SELECT tile_id, y, x, CASE WHEN prob_a > 0.5 THEN 1 ELSE 0 END AS mask FROM pixels")
def a13_binary_product(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, products.binary_product(bands.binarised(F.col("prob_a"))).alias("mask"))


@query(
    f"{DECODED} SELECT product, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT 'red' AS product, red AS value FROM decoded UNION ALL SELECT 'green', green FROM decoded "
    "UNION ALL SELECT 'blue', blue FROM decoded UNION ALL SELECT 'nir', nir FROM decoded UNION ALL SELECT 'prob_a', prob_a FROM decoded) GROUP BY product"
)
def a15_route_products(spark, sf_dir):
    long = products.route(decoded(spark, sf_dir), ["optical", "prob_a"])
    return long.groupBy("product").agg(F.count("*").alias("n"), r6(F.sum("value"), 4).alias("total"))


@query(f"{_P} SELECT tile_id, y, x, round(CASE WHEN s2_observations <> 0 AND red_dn <> 0 THEN red_dn / 10000 END, 6) AS red FROM pixels")
def b14b_mosaic_reflectance(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, r6(bands.reflectance_mosaic(F.col("red_dn"), F.col("s2_observations"))).alias("red"))


@query(f"{_P} SELECT tile_id, y, x, round(CASE WHEN clear_sky <> 0 AND red_dn <> 0 THEN red_dn / 250 END, 6) AS red FROM pixels")
def b14c_landsat_reflectance(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, r6(bands.reflectance_landsat(F.col("red_dn"), F.col("clear_sky"))).alias("red"))


@query(
    "SELECT o_orderkey, round(CAST(o_orderkey % 4001 AS INT) / 10000 - CASE WHEN o_orderdate >= TIMESTAMP '1998-01-25' THEN 0.1 ELSE 0.0 END, 6) + 0.0 AS red FROM orders"
)
def b14d_dated_reflectance(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", r6(bands.reflectance_dated(F.col("o_orderkey") % 4001, F.col("o_orderdate"), since="1998-01-25")).alias("red"))


@query(f"{_P} SELECT tile_id, y, x, round(red_dn / 10000, 6) AS red FROM pixels")
def b14e_planet_reflectance(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, r6(bands.reflectance_planet(F.col("red_dn"))).alias("red"))


@query(
    f"{_P} SELECT tile_id, y, x, CASE WHEN s2_scl IN (0, 1) THEN 0 WHEN s2_scl IN (2, 4, 5, 6, 7, 10) THEN 2 ELSE 1 END AS by_scl, "
    "CASE WHEN s2_observations = 0 THEN 0 WHEN s2_observations <= 3 THEN 1 ELSE 2 END AS by_observations, CASE WHEN clear_sky = 0 THEN 0 WHEN clear_sky < 1 THEN 1 ELSE 2 END AS by_clear_sky, "
    "CASE WHEN s2_scl % 5 = 4 THEN 0 WHEN greatest(s2_scl % 2, CASE WHEN red_dn % 7 = 0 THEN 1 ELSE 0 END, 0) = 1 THEN 1 ELSE 2 END AS by_udm FROM pixels"
)
def b15_quality_masks(spark, sf_dir):
    p = pixels(spark, sf_dir)
    zero = F.lit(0)
    udm = [F.lit(1), F.col("s2_scl") % 2, (F.col("red_dn") % 7 == 0).cast("int"), zero, zero, zero, zero, (F.col("s2_scl") % 5 == 4).cast("int")]
    return p.select(
        *CELL,
        bands.quality_from_scl(F.col("s2_scl")).alias("by_scl"),
        bands.quality_from_observations(F.col("s2_observations")).alias("by_observations"),
        bands.quality_from_clear_sky(F.col("clear_sky")).alias("by_clear_sky"),
        bands.quality_from_udm(udm).alias("by_udm"),
    )


@query(
    f"{DECODED}, lost AS (SELECT *, CASE WHEN s2_scl <> 9 THEN s2_scl END AS scl FROM decoded) SELECT tile_id, y, x, CASE WHEN scl IS NOT NULL AND (red IS NULL OR nir IS NULL) THEN 0 ELSE quality END AS quality, "
    "round(CASE WHEN scl IS NOT NULL THEN coalesce(red, 0.0) END, 6) AS red, round(CASE WHEN scl IS NOT NULL THEN coalesce(nir, 0.0) END, 6) AS nir FROM lost"
)
def b16_repair_missing(spark, sf_dir):
    d = decoded(spark, sf_dir).withColumn("scl", F.when(F.col("s2_scl") != 9, F.col("s2_scl")))
    return rounded(bands.repair(d, ["red", "nir"], "quality", "scl"), ["red", "nir"]).select(*CELL, "quality", "red", "nir")


@query(f"{DECODED} SELECT tile_id, y, x, round(CASE WHEN quality = 2 THEN prob_a END, 6) AS p, coalesce(CASE WHEN quality = 2 THEN prob_a END, 0.0) > 0.5 AS mask, quality >= 1 AS usable FROM decoded")
def b17_b20_b21_mask_and_threshold(spark, sf_dir):
    d = decoded(spark, sf_dir).withColumn("p", bands.within(F.col("prob_a"), F.col("quality") == 2))
    return d.select(*CELL, r6("p").alias("p"), bands.binarised(F.col("p")).alias("mask"), (F.col("quality") >= bands.quality_level("low_quality")).alias("usable"))


@query(f"{_P} SELECT tile_id, y, x, round(least(greatest(dem * 10 - 2200, -100.0), 3000.0), 6) AS dem, coalesce(CASE WHEN s2_scl <> 3 THEN s2_scl END, 0) AS trend FROM pixels")
def b18_auxiliary_cleanup(spark, sf_dir):
    p = pixels(spark, sf_dir)
    dem, trend = bands.auxiliary(F.col("dem") * 10 - 2200, F.when(F.col("s2_scl") != 3, F.col("s2_scl")))
    return p.select(*CELL, r6(dem).alias("dem"), trend.alias("trend"))


@query(
    "SELECT event_id, CAST(round_even(coalesce(TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'x' WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 90 AS STRING) || '.5' END AS DOUBLE), 225.0), 0) AS INT) AS azimuth FROM events"
)
def b19_sun_angles(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 7 == 0, "x").when(F.col("event_id") % 5 == 0, None).otherwise(F.concat((F.col("event_id") % 90).cast("string"), F.lit(".5")))
    return e.select("event_id", bands.sun_angle(raw, 225).alias("azimuth"))


def _codec_sql(b: str) -> str:
    return f"coalesce(CAST(round_even(({b} + 0.1) / 0.0001, 0) AS INT), 0) AS {b}_disk"


@query(f"{DECODED} SELECT tile_id, y, x, {_codec_sql('red')}, {_codec_sql('nir')}, coalesce(CAST(round_even(prob_a / 0.01, 0) AS INT), 255) AS prob_disk FROM decoded")
def c1_encode(spark, sf_dir):
    d = decoded(spark, sf_dir)
    return d.select(*CELL, codecs.encode(F.col("red"), codecs.lookup("red")).alias("red_disk"), codecs.encode(F.col("nir"), codecs.lookup("nir")).alias("nir_disk"), codecs.encode(F.col("prob_a"), codecs.lookup("probabilities-a")).alias("prob_disk"))


@query(f"{_P} SELECT tile_id, y, x, round(CASE WHEN red_dn <> 0 THEN CAST(red_dn AS DOUBLE) * 1e-4 + -1e-1 END, 6) + 0.0 AS red, s2_scl FROM pixels")
def c2_decode(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return p.select(*CELL, r6(codecs.decode(F.col("red_dn"), codecs.lookup("red"))).alias("red"), codecs.decode(F.col("s2_scl"), codecs.lookup("s2_scl")).alias("s2_scl"))


@query(
    f"{DECODED} SELECT tile_id, y, x, round(least(greatest(coalesce((red - -0.1) / (0.5 - -0.1), 0.0), 0.0), 1.0), 6) AS red, round(s2_scl / 11, 6) AS s2_scl, round(CASE WHEN nir IS NOT NULL THEN least(greatest(nir, -0.1), 0.5) END, 6) + 0.0 AS nir_cropped FROM decoded"
)
def c3_c4_normalise_and_crop(spark, sf_dir):
    d = decoded(spark, sf_dir)
    return d.select(*CELL, r6(codecs.normalise(F.col("red"), codecs.lookup("red"))).alias("red"), r6(codecs.normalise(F.col("s2_scl"), codecs.lookup("s2_scl"))).alias("s2_scl"), r6(codecs.crop(F.col("nir"), codecs.lookup("nir"))).alias("nir_cropped"))


@query(
    "WITH c AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE 0.01 END AS scale, CASE WHEN p_size % 4 = 0 THEN NULL ELSE 0.0 END AS off, CASE WHEN p_size % 5 = 0 THEN 255 END AS fill, p_size / 10 AS vmax FROM part) "
    "SELECT p_partkey AS band, reason FROM (SELECT p_partkey, 'scale and offset go together' AS reason FROM c WHERE (scale IS NULL) <> (off IS NULL) UNION ALL "
    "SELECT p_partkey, 'only scaled bands have a fill value' FROM c WHERE fill IS NOT NULL AND scale IS NULL UNION ALL "
    "SELECT p_partkey, 'range does not fit the storage type' FROM c WHERE CASE WHEN scale IS NULL THEN vmax ELSE (vmax - off) / scale END > 255.5)"
)
def c5_codec_faults(spark, sf_dir):
    size = F.col("p_size")
    c = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("band"),
        F.lit("uint8").alias("disk"),
        F.lit(0.0).alias("vmin"),
        (size / 10).alias("vmax"),
        F.when(size % 3 != 0, 0.01).alias("scale"),
        F.when(size % 4 != 0, 0.0).alias("offset"),
        F.when(size % 5 == 0, 255.0).alias("fill"),
    )
    return codecs.faults(c)


@query(
    "SELECT DISTINCT CASE p_size % 6 WHEN 0 THEN 'probabilities-' || p_size WHEN 1 THEN 'ndvi' WHEN 2 THEN 's2-scl' WHEN 3 THEN 'tcXwetness' WHEN 4 THEN 's2_scl' ELSE 'slope' END AS name, "
    "CASE p_size % 6 WHEN 0 THEN 'probabilities-*' WHEN 1 THEN 'ndvi' WHEN 4 THEN 's2_scl' WHEN 5 THEN 'slope' END AS codec FROM part"
)
def c6_codec_lookup(spark, sf_dir):
    size = F.col("p_size")
    names = F.array(F.concat(F.lit("probabilities-"), size.cast("string")), *map(F.lit, ("ndvi", "s2-scl", "tcXwetness", "s2_scl", "slope")))
    return codecs.lookup_table(table(spark, sf_dir, "part").select(F.get(names, size % 6).alias("name")).distinct(), codecs.as_table(spark))


_NAMES = ["ndvi", "gndvi", "grvi", "vigreen", "rvi", "nrvi", "tvi", "ctvi", "ttvi", "savi", "evi", "vari", "gli", "vdvi", "tgi", "exg"]
_I = (
    f"{DECODED}, c AS (SELECT *, CASE WHEN blue IS NOT NULL THEN least(greatest(blue, 0.0), 1.0) END AS b, CASE WHEN green IS NOT NULL THEN least(greatest(green, 0.0), 1.0) END AS g, "
    "CASE WHEN red IS NOT NULL THEN least(greatest(red, 0.0), 1.0) END AS r, CASE WHEN nir IS NOT NULL THEN least(greatest(nir, 0.0), 1.0) END AS n FROM decoded), "
    "v AS (SELECT *, CASE WHEN (n - r) / nullif(n + r, 0) IS NOT NULL THEN least(greatest((n - r) / nullif(n + r, 0), -1.0), 1.0) END AS v FROM c)"
)


_FREE = {
    "evi": "2.5 * (n - r) / nullif(n + r * 6 - b * 7.5 + 1, 0)",
    "vari": "(g - r) / nullif(g + r - b, 0)",
    "gli": "(2 * green - red - blue) / nullif(2 * green + red + blue, 0)",
    "vdvi": "(2 * green - red - blue) / nullif(2 * green + red + blue, 0)",
}


@query(
    f"{_I} SELECT tile_id, y, x, round(v, 6) + 0.0 AS ndvi, round((n - g) / nullif(n + g, 0), 6) + 0.0 AS gndvi, round((g - r) / nullif(g + r, 0), 6) + 0.0 AS grvi, round((g - r) / nullif(g + r, 0), 6) + 0.0 AS vigreen, "
    "round(r / nullif(n, 0), 6) + 0.0 AS rvi, round((r / nullif(n, 0) - 1) / nullif(r / nullif(n, 0) + 1, 0), 6) + 0.0 AS nrvi, round(CASE WHEN v + 0.5 >= 0 THEN sqrt(abs(v + 0.5)) END, 6) + 0.0 AS tvi, "
    "round((v + 0.5) / nullif(abs(v + 0.5), 0) * sqrt(abs(v + 0.5)), 6) + 0.0 AS ctvi, round(sqrt(abs(v) + 0.5), 6) + 0.0 AS ttvi, round(v * 1.5, 6) + 0.0 AS savi, "
    + ", ".join(f"round({x} / (1 + abs({x})), 6) + 0.0 AS {k}" for k, x in _FREE.items())
    + ", round(((r - g) * 190 - (r - b) * 120) * -0.5, 6) + 0.0 AS tgi, round(g * 2 - r - b, 6) + 0.0 AS exg FROM v"
)
def d1_d16_spectral_indices(spark, sf_dir):
    """All cells; indices without bounds are shown as x / (1 + abs(x)), so that near-zero denominators compare."""
    d = indices.add_indices(decoded(spark, sf_dir), _NAMES)
    return d.select(*CELL, *(r6(F.col(k) / (F.abs(k) + 1) if k in _FREE else k).alias(k) for k in _NAMES))


@query(
    f"{_I} SELECT tile_id, y, x, round((1 + 0.5) * (n - r) / nullif(n + r + 0.5, 0), 6) + 0.0 AS savi, round((1 + 0.25) * (n - r) / nullif(n + r + 0.25, 0), 6) + 0.0 AS savi_quarter, round((g - n) / nullif(g + n, 0), 6) + 0.0 AS ndwi, "
    "round(1.5 * (n - r) / nullif(n + r + 0.5, 0), 6) + 0.0 AS own FROM v"
)
def d17_named_index(spark, sf_dir):
    """From the registry, from the registry with an operand in place of a constant, and from a formula."""
    d = indices.registered_index(decoded(spark, sf_dir), "SAVI", L=0.25).withColumnRenamed("savi", "savi_quarter")
    d = indices.registered_index(indices.registered_index(d, "SAVI"), "NDWI")
    d = indices.named_index(d, "own", "try_divide(1.5 * (nir - R), nir + R + L)", {"L": 0.5})
    return d.select(*CELL, *(r6(c).alias(c) for c in ("savi", "savi_quarter", "ndwi", "own")))


@query(f"{_P} SELECT tile_id, y, x, round((coalesce(CASE WHEN s2_scl <> 2 THEN prob_a END, 0.0) + prob_b) / (1 + CASE WHEN s2_scl <> 2 THEN 1 ELSE 0 END), 6) AS probabilities FROM pixels")
def g2_ensemble_mean(spark, sf_dir):
    p = pixels(spark, sf_dir).withColumn("prob_a", F.when(F.col("s2_scl") != 2, F.col("prob_a")))
    return patches.ensemble(p, ["prob_a", "prob_b"]).select(*CELL, r6("probabilities").alias("probabilities"))


@query(
    f"{DECODED} SELECT tile_id, band, round(min(v), 6) + 0.0 AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM (SELECT tile_id, 'red' AS band, red AS v FROM decoded UNION ALL SELECT tile_id, 'nir', nir FROM decoded) GROUP BY tile_id, band"
)
def g29_band_statistics(spark, sf_dir):
    return rounded(bands.band_statistics(decoded(spark, sf_dir), ["red", "nir"]), ["min", "max", "mean", "std"])


_FLAG = "1 / (1 + exp(-(coalesce(ndvi, 0.0) * 2.0 + coalesce(rn, 0.0) * -1.5 + 0.25)))"


@query(
    f"{_I}, s AS (SELECT tile_id, quality, v AS ndvi, least(greatest(coalesce((red - -0.1) / (0.5 - -0.1), 0.0), 0.0), 1.0) AS rn FROM v), p AS (SELECT tile_id, quality, {_FLAG} AS p FROM s) "
    "SELECT tile_id, count(*) AS n, sum(CASE WHEN quality >= 1 AND p > 0.5 THEN 1 ELSE 0 END) AS positives, round(avg(p), 6) AS mean_p FROM p GROUP BY tile_id"
)
def flagship_segment_tiles(spark, sf_dir):
    d = indices.add_indices(decoded(spark, sf_dir), ["ndvi"]).withColumn("rn", codecs.normalise(F.col("red"), codecs.lookup("red")))
    d = d.withColumn("p", patches.logistic({"ndvi": 2.0, "rn": -1.5}, 0.25))
    hit = bands.binarised(F.col("p")) & (F.col("quality") >= 1)
    return d.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum(hit.cast("long")).alias("positives"), r6(F.avg("p")).alias("mean_p"))


@query(f"{_P} SELECT tile_id, y, x, round(1 / (1 + exp(-(prob_a * 3.0 + prob_b * -2.0 + 0.1))), 6) AS p FROM pixels")
def h5_logistic_scorer(spark, sf_dir):
    return pixels(spark, sf_dir).select(*CELL, r6(patches.logistic({"prob_a": 3.0, "prob_b": -2.0}, 0.1)).alias("p"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS n_layers FROM part")
def b22_required_layers(spark, sf_dir):
    layers = {"terrain": ["slope", "aspect"], "trend": ["tc_wetness"]}
    wants = {k: len(bands.required_layers(n, layers)) for k, n in enumerate((["ndvi"], ["slope"], ["tc_wetness"], ["slope", "tc_wetness", "red"]))}
    size = F.col("p_size")
    pick = (size % 2 == 0).cast("int") + (size % 3 == 0).cast("int") * 2
    return table(spark, sf_dir, "part").select("p_partkey", F.get(F.array(*(F.lit(v) for v in wants.values())), pick).alias("n_layers"))


