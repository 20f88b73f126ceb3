"""Volume statistics of scene archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def per_cell(scenes: DataFrame, cell: str = "grid_code", cell_km2: float = 100.0, resolution_m: float = 10.0, bytes_per_pixel: float = 8.0) -> DataFrame:
    """Scenes of each grid cell, with area, pixels and download size."""
    n = F.count("*")
    pixels = cell_km2 * 1e6 / (resolution_m * resolution_m)
    return scenes.groupBy(cell).agg(n.alias("n"), (n * cell_km2).alias("km2"), (n * pixels).cast("long").alias("pixels"), (n * pixels * bytes_per_pixel / 1e9).alias("gb"))


def under_cloud(scenes: DataFrame, thresholds: Sequence[int], area_km2: float = 1.0) -> DataFrame:
    """Scenes and area by year, month and cloud limit (each limit takes in the ones below)."""
    counted = scenes.groupBy("year", "month").agg(*(F.count_if(F.col("cloud") <= t).alias(f"c{t}") for t in thresholds))
    rows = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"c{t}").alias("n")) for t in thresholds))
    return counted.select("year", "month", F.explode(rows).alias("r")).select("year", "month", "r.threshold", "r.n", (F.col("r.n") * area_km2).alias("area"))


def monthly_average(scenes: DataFrame, months: Sequence[int], skip_years: Sequence[int]) -> DataFrame:
    """Mean scenes a month over the years that are left."""
    kept = scenes.where(F.col("month").isin(list(months)) & ~F.col("year").isin(list(skip_years)))
    return kept.groupBy("year", "month").agg(F.count("*").alias("n")).groupBy("month").agg(F.avg("n").alias("mean_scenes"))


def scene_rows(scenes: DataFrame, properties: str = "properties") -> DataFrame:
    """One row for each scene: area, snow, cloud and other shares from JSON, grid code."""
    number = lambda path: F.get_json_object(properties, f"$.{path}").try_cast("double")
    return scenes.select("scene_id", ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).cast("double").alias("km2"), number("snow").alias("snow"), number("cloud").alias("cloud"), number("water").alias("water"), number("nodata").alias("nodata"), "grid_code")


def grid_selection(cells: DataFrame, land: DataFrame, max_lat: float, land_class: str) -> DataFrame:
    """Cells up to a latitude whose centre cell has a class of land; both by ``cell``."""
    return cells.where(F.abs("lat") <= max_lat).join(land.where(F.col("kind") == land_class).select("cell").distinct(), "cell", "left_semi")
