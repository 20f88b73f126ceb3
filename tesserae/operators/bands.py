"""Reflectance, quality masks and band repair as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.safe import clip

#: Scene classes by quality (0 invalid, 1 low, 2 high).
SCL_INVALID = (0, 1)
SCL_HIGH = (2, 4, 5, 6, 7, 10)
OPTICAL = ("blue", "green", "red", "nir")
LEVELS = {"high_quality": 2, "low_quality": 1, "none": 0}


def reflectance_scene(dn: Column, scl: Column) -> Column:
    return F.when((scl != 0) & (dn != 0), dn / 10000 - 0.1)


def reflectance_mosaic(dn: Column, observations: Column) -> Column:
    return F.when((observations != 0) & (dn != 0), dn / 10000)


def reflectance_landsat(dn: Column, clear_sky: Column) -> Column:
    return F.when((clear_sky != 0) & (dn != 0), dn / 250)


def reflectance_dated(dn: Column, acquired: Column, since: str = "2022-01-25", offset: float = 0.1) -> Column:
    return dn / 10000 - F.when(acquired >= F.lit(since).cast("timestamp"), offset).otherwise(0.0)


def reflectance_planet(dn: Column) -> Column:
    return dn / 10000


def quality_from_scl(scl: Column) -> Column:
    return F.when(scl.isNull() | scl.isin(*SCL_INVALID), 0).when(scl.isin(*SCL_HIGH), 2).otherwise(1)


def quality_from_observations(n: Column) -> Column:
    return F.when(n.isNull() | (n == 0), 0).when(n <= 3, 1).otherwise(2)


def quality_from_clear_sky(share: Column) -> Column:
    return F.when(share.isNull() | (share == 0), 0).when(share < 1, 1).otherwise(2)


def quality_from_udm(udm: Sequence[Column]) -> Column:
    """``udm`` holds the eight bands in order."""
    return F.when(udm[7] != 0, 0).when(F.greatest(*udm[1:6]) == 1, 1).otherwise(2)


def decode_scene(pixels: DataFrame, bands: Sequence[str] = OPTICAL) -> DataFrame:
    """Reflectance of each band and the quality mask; ``<band>_dn`` and ``s2_scl`` are read."""
    made = {b: reflectance_scene(F.col(f"{b}_dn"), F.col("s2_scl")) for b in bands}
    return pixels.withColumns(made | {"quality": quality_from_scl(F.col("s2_scl"))})


def repair(pixels: DataFrame, bands: Sequence[str], quality: str, scl: str) -> DataFrame:
    """A missing band value makes quality 0 and the value 0; pixels without a scene class stay missing."""
    lost = reduce(lambda a, b: a | b, [F.col(b).isNull() for b in bands])
    here = F.col(scl).isNotNull()
    fixed = {b: F.when(here, F.coalesce(b, F.lit(0.0))) for b in bands}
    return pixels.withColumns({quality: F.when(here & lost, 0).otherwise(F.col(quality))} | fixed)


def within(value: Column, extent: Column) -> Column:
    return F.when(extent, value)


def auxiliary(dem: Column, trend: Column) -> tuple[Column, Column]:
    """Elevation clipped to [-100, 3000]; a missing trend is 0."""
    return clip(dem, -100.0, 3000.0), F.coalesce(trend, F.lit(0))


def sun_angle(value: Column, default: int) -> Column:
    return F.bround(F.coalesce(value.try_cast("double"), F.lit(float(default)))).cast("int")


def quality_level(level: str | int) -> int:
    return LEVELS[level] if isinstance(level, str) else level


def binarised(p: Column, threshold: float = 0.5) -> Column:
    return F.coalesce(p, F.lit(0.0)) > threshold


def required_layers(needed: Sequence[str], layers: Mapping[str, Sequence[str]]) -> list[str]:
    """The auxiliary layers of which a model needs a band."""
    return [name for name, bands in layers.items() if set(needed) & set(bands)]


def rename_bands(df: DataFrame, mapping: Mapping[str, str], wanted: Sequence[str] | str, mask: str) -> DataFrame:
    """Source bands by their common names; the mask band always comes along, ``"all"`` takes every band."""
    names = list(mapping) if wanted == "all" else [s for s, c in mapping.items() if c in wanted]
    rest = [c for c in df.columns if c not in mapping and c != mask]
    return df.select(*rest, *(F.col(s).alias(mapping[s]) for s in names), F.col(mask))


def band_statistics(pixels: DataFrame, bands: Sequence[str], by: str = "tile_id") -> DataFrame:
    """Least, most, mean and population deviation of each band in long form."""
    long = pixels.select(by, *bands).unpivot([by], list(bands), "band", "value")
    return long.groupBy(by, "band").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
