"""Reading labelled files, and writing products, ledgers and training sets as Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tesserae.functions.rank import numbered

TILE = "tile_id"
#: Products by name and the bands of the composite ones.
COMPOSITES = {"optical": ("red", "green", "blue", "nir"), "dem": ("slope", "relative_elevation", "aspect", "hillshade", "curvature"), "tcvis": ("tc_brightness", "tc_greenness", "tc_wetness")}


def read_all(spark: SparkSession, paths: Sequence[str], kind: str = "parquet") -> DataFrame:
    """Several files as one table; columns that a file lacks are NULL."""
    return spark.read.format(kind).option("mergeSchema", True).load(list(paths))


def probability_product(p: Column) -> Column:
    """Percent as a whole number, 255 where missing."""
    return F.coalesce((p * 100).cast("int"), F.lit(255))


def binary_product(mask: Column) -> Column:
    return F.coalesce(mask.cast("int"), F.lit(0))


def route(pixels: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """``tile_id, product, y, x, value`` of the wanted products; composites are groups of bands."""
    bands: list[str] = []
    for name in wanted:
        parts = COMPOSITES.get(name, (name,))
        for part in parts:
            if part not in pixels.columns:
                raise ValueError(f"no such product: {name}")
            bands.append(part)
    typed = pixels.select(TILE, "y", "x", *(F.col(b).cast("double").alias(b) for b in dict.fromkeys(bands)))
    return typed.unpivot([TILE, "y", "x"], list(dict.fromkeys(bands)), "product", "value")


def write_products(long: DataFrame, path: str) -> None:
    long.write.mode("overwrite").partitionBy("product").parquet(path)


def with_metadata(tiles: DataFrame, parameters: Mapping[str, object], prefix: str = "RUN_") -> DataFrame:
    """Each tile's row with the run's parameters and the time of export."""
    return tiles.withColumns({f"{prefix}{k}".upper(): F.lit(v) for k, v in parameters.items()} | {"exported_at": F.current_timestamp()})


def output_state(tiles: DataFrame, listing: DataFrame, products: Sequence[str]) -> DataFrame:
    """``state`` all, some or none by how many expected products of a tile are listed, and which are missing."""
    need = tiles.select(TILE).distinct().withColumn("product", F.explode(F.array(*map(F.lit, products))))
    got = need.join(listing.select(TILE, "product").distinct().withColumn("_there", F.lit(1)), [TILE, "product"], "left")
    n = F.count("_there")
    return got.groupBy(TILE).agg(F.when(n == len(products), "all").when(n > 0, "some").otherwise("none").alias("state"), (F.lit(len(products)) - n).alias("missing"))


def with_ledger(tiles: DataFrame, work: Callable[[pd.DataFrame], object], block: int = 1024) -> DataFrame:
    """Run ``work`` on each tile's rows; a failing tile becomes a ledger row with its error, the rest go on.

    Rows with ``y`` and ``x`` come in blocks of ``block`` cells a side, so that no tile has to fit into one task: a
    tile fails with the first of its blocks that fails, else its path is that of its first block.
    """
    place = [F.floor(F.col(c) / block).cast("int") if c in tiles.columns else F.lit(0) for c in ("y", "x")]
    kind = tiles.schema[TILE].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            path, error = str(work(rows.drop(columns=["_by", "_bx"]))), None
        except Exception as e:  # noqa: BLE001  a tile's failure is a result
            path, error = None, f"{type(e).__name__}: {e}"
        return pd.DataFrame({TILE: [rows[TILE].iloc[0]], "by": [rows["_by"].iloc[0]], "bx": [rows["_bx"].iloc[0]], "path": [path], "error": [error]})

    blocks = tiles.withColumns({"_by": place[0], "_bx": place[1]}).groupBy(TILE, "_by", "_bx").applyInPandas(run, f"{TILE} {kind}, by int, bx int, path string, error string")
    at = F.struct("by", "bx")
    found = blocks.groupBy(TILE).agg(F.min_by("path", F.when(F.col("path").isNotNull(), at)).alias("path"), F.min_by("error", F.when(F.col("error").isNotNull(), at)).alias("error"))
    failed = F.col("error").isNotNull()
    return found.select(TILE, F.when(~failed, F.col("path")).alias("output_path"), F.when(failed, "failed").otherwise("success").alias("status"), "error")


def number_rows(new: DataFrame, old: DataFrame | None, order: str) -> DataFrame:
    """``z_idx`` of new training rows, going on from the stored ones; ``order`` is unique."""
    first = 0 if old is None else old.agg(F.coalesce(F.max("z_idx") + 1, F.lit(0)).alias("n")).first()["n"]
    return numbered(new, [order], "z_idx", first)


def patch_values(cells: DataFrame, kept: DataFrame, bands: Sequence[str], label: str, size: int) -> DataFrame:
    """``z_idx`` and the cells of each kept patch in order, an array of ``size`` squared; missing values of bands are 0."""
    rows = cells.join(kept.select("z_idx", TILE, "patch_id").hint("merge"), [TILE, "patch_id"])
    values = [F.coalesce(F.col(b).cast("float"), F.lit(0.0).cast("float")).alias(f"v{i}") for i, b in enumerate(bands)]
    cell = F.struct((F.col("dy") * size + F.col("dx")).alias("i"), F.col(label).cast("byte").alias("label"), *values)
    return rows.groupBy("z_idx").agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def split_values(patches: DataFrame, bands: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``x`` and ``y`` of ``training_tables`` from ``patch_values``."""
    of = lambda name: F.transform("cells", lambda c: c[name]).alias("values")
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), of(f"v{i}")) for i, b in enumerate(bands))))
    return patches.select("z_idx", each.alias("_x")).select("z_idx", "_x.*"), patches.select("z_idx", of("label"))


def training_tables(cells: DataFrame, kept: DataFrame, bands: Sequence[str], label: str, size: int) -> tuple[DataFrame, DataFrame]:
    """``x`` (z_idx, band, values) and ``y`` (z_idx, values) of the kept patches; missing values are 0.

    Each of them gathers the cells; to have both from one pass, split stored ``patch_values``.
    """
    return split_values(patch_values(cells, kept, bands, label, size), bands)
