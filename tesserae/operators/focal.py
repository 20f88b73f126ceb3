"""Neighbourhood operators: window frames along rows, then along columns. A cell whose neighbourhood leaves the tile is NULL."""

from __future__ import annotations

from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tesserae.functions.safe import clip, div, shifted

TILE = "tile_id"


def along_row():
    return Window.partitionBy(TILE, "y").orderBy("x")


def along_column():
    return Window.partitionBy(TILE, "x").orderBy("y")


def neighbours(df: DataFrame, band: str) -> DataFrame:
    """The 3x3 neighbourhood as ``nw n ne w e sw s se`` and ``_full``: two window passes."""
    wide = df.withColumns({"_w": F.lag(band).over(along_row()), "_e": F.lead(band).over(along_row())})
    names = {"nw": ("_w", 1), "n": (band, 1), "ne": ("_e", 1), "sw": ("_w", -1), "s": (band, -1), "se": ("_e", -1)}
    wide = wide.withColumns({k: shifted(F.col(c), by, along_column()) for k, (c, by) in names.items()})
    return wide.withColumns({"w": F.col("_w"), "e": F.col("_e")}).drop("_w", "_e")


def terrain(df: DataFrame, band: str = "dem", resolution: float = 10.0, azimuth: Column | float = 225.0, altitude: Column | float = 25.0) -> DataFrame:
    """``slope`` and ``aspect`` (degrees), ``hillshade`` (0 to 1) and ``curvature``, sharing one neighbourhood.

    The sun's angles are numbers or columns, so that tiles can have their own; see ``with_sun``.
    """
    azimuth, altitude = (v if isinstance(v, Column) else F.lit(float(v)) for v in (azimuth, altitude))
    a, b, c, d, f, g, h, i = (F.col(k) for k in ("nw", "n", "ne", "w", "e", "sw", "s", "se"))
    z = F.col(band)
    dzdx = ((c + f * 2 + i) - (a + d * 2 + g)) / (8 * resolution)
    dzdy = ((g + h * 2 + i) - (a + b * 2 + c)) / (8 * resolution)
    out = neighbours(df, band).withColumns({"_dx": dzdx, "_dy": dzdy})
    dx, dy = F.col("_dx"), F.col("_dy")
    steep = F.atan(F.sqrt(dx * dx + dy * dy))
    facing = F.atan2(dy, -dx)
    flat = (dx == 0) & (dy == 0)
    compass = F.pmod(F.lit(90.0) - F.degrees(facing), F.lit(360.0))
    light, height = F.radians(F.lit(90.0) - azimuth), F.radians(altitude)
    shade = F.sin(height) * F.cos(steep) + F.cos(height) * F.sin(steep) * F.cos(light - facing)
    area = (d + f) / 2 - z, (b + h) / 2 - z
    return out.withColumns(
        {
            "slope": F.degrees(steep),
            "aspect": F.when(flat, -1.0).when(dx.isNotNull() & dy.isNotNull(), compass),
            "hillshade": clip(shade, 0.0, 1.0),
            "curvature": (area[0] + area[1]) * -2 * 100 / (resolution * resolution),
        }
    ).drop("_dx", "_dy", "nw", "n", "ne", "w", "e", "sw", "s", "se")


def true_north(aspect: Column, correction: Column) -> Column:
    """Aspect turned by a correction in degrees; flat cells stay -1."""
    return F.when(aspect == -1, -1.0).otherwise(F.pmod(aspect + correction, F.lit(360.0)))


def sun_correction(tiles: DataFrame, x: str, y: str) -> DataFrame:
    """Turn of each tile's grid against north, from its mean position on a polar grid."""
    return tiles.groupBy(TILE).agg(F.degrees(F.atan2(F.avg(x), F.avg(y))).alias("_m")).select(TILE, (F.col("_m") + 90).alias("correction"))


def with_sun(cells: DataFrame, tiles: DataFrame, x: str, y: str) -> DataFrame:
    """Cells with ``azimuth`` (turned to the tile's grid) and ``elevation`` of their tile's own sun, for ``terrain``.

    ``tiles`` has those angles, one row for each tile; ``x, y`` are the cells' positions on a polar grid. The table of
    angles is small beside the cells; Spark decides by its size how it is joined.
    """
    turned = tiles.select(TILE, "azimuth", "elevation").join(sun_correction(cells, x, y), TILE)
    angle = F.pmod(F.col("azimuth") + F.col("correction"), F.lit(360.0))
    return cells.join(turned.select(TILE, angle.alias("azimuth"), "elevation"), TILE)


def square(df: DataFrame, band: str, half: int, how: dict[str, object]) -> DataFrame:
    """Separable statistics over a square of ``2 * half + 1`` cells: ``how`` is name -> aggregate function."""
    rows, cols = along_row().rangeBetween(-half, half), along_column().rangeBetween(-half, half)
    counted = df.withColumns({"_n": F.count(band).over(rows)} | {f"_{k}": f(band).over(rows) for k, f in how.items()})
    again = {"avg": F.avg}
    counted = counted.withColumns({"_n2": F.sum("_n").over(cols)} | {k: again.get(k, f)(f"_{k}").over(cols) for k, f in how.items()})
    size = (2 * half + 1) ** 2
    return counted.withColumns({k: F.when(F.col("_n2") == size, F.col(k)) for k in how}).drop("_n", "_n2", *(f"_{k}" for k in how))


def disk_sum(df: DataFrame, band: str, radius: int) -> DataFrame:
    """``df`` with ``total`` and ``cells`` over a disk: one row frame for each width, then one column frame for each row of the disk."""
    widths = {dy: isqrt(radius * radius - dy * dy) for dy in range(-radius, radius + 1)}
    frames = {}
    for w in sorted(set(widths.values())):
        frame = along_row().rangeBetween(-w, w)
        frames |= {f"_s{w}": F.sum(band).over(frame), f"_c{w}": F.count(band).over(frame)}
    framed = df.withColumns(frames)
    at = lambda name, dy: F.coalesce(F.sum(name).over(along_column().rangeBetween(dy, dy)), F.lit(0))
    rows = framed.withColumns({f"_t{dy + radius}": at(f"_s{w}", dy) for dy, w in widths.items()} | {f"_n{dy + radius}": at(f"_c{w}", dy) for dy, w in widths.items()})
    add = lambda name: reduce(lambda x, y: x + y, [F.col(f"{name}{k}") for k in range(2 * radius + 1)])
    return rows.withColumns({"total": add("_t"), "cells": add("_n")}).select(*df.columns, "total", "cells")


def disk_size(radius: int) -> int:
    return sum(2 * isqrt(radius * radius - dy * dy) + 1 for dy in range(-radius, radius + 1))


def tpi(df: DataFrame, band: str = "dem", outer: int = 3, inner: int = 0) -> DataFrame:
    """Height over the mean of a disk, or of the ring between two radii if ``inner`` is over 0."""
    joined = disk_sum(df, band, outer)
    size = disk_size(outer)
    whole = F.col("cells") == size
    if inner > 0:
        ring = joined.withColumnsRenamed({"total": "_outer", "cells": "_all"})
        joined = disk_sum(ring, band, inner).withColumnsRenamed({"total": "_t", "cells": "_c"}).withColumnsRenamed({"_outer": "total", "_all": "cells"})
        mean = (F.col("total") - F.col("_t")) / (size - disk_size(inner))
    else:
        mean = F.col("total") / size
    return joined.withColumn("relative_elevation", F.when(whole, F.col(band) - mean)).drop("total", "cells", "_t", "_c")


def tri(df: DataFrame, band: str = "dem", half: int = 1) -> DataFrame:
    """Ruggedness: root of the summed squared differences to the neighbours."""
    k = (2 * half + 1) ** 2
    sums = square(df.withColumn("_z2", F.col(band) * F.col(band)), band, half, {"s1": F.sum})
    sums = square(sums, "_z2", half, {"s2": F.sum})
    z = F.col(band)
    inside = z * z * (k - 1) - z * 2 * (F.col("s1") - z) + (F.col("s2") - z * z)
    return sums.withColumn("tri", F.when(inside.isNotNull(), F.sqrt(F.greatest(inside, F.lit(0.0))))).drop("_z2", "s1", "s2")


def vrm(df: DataFrame, half: int = 1) -> DataFrame:
    """Vector ruggedness from ``slope`` and ``aspect``: one less the length of the mean unit normal."""
    slope, aspect = F.radians("slope"), F.radians("aspect")
    flat = F.col("aspect") == -1
    normal = df.withColumns({"_x": F.when(flat, 0.0).otherwise(F.sin(slope) * F.sin(aspect)), "_y": F.when(flat, 0.0).otherwise(F.sin(slope) * F.cos(aspect)), "_z": F.cos(slope)})
    for axis in ("x", "y", "z"):
        normal = square(normal, f"_{axis}", half, {f"m{axis}": F.sum})
    k = (2 * half + 1) ** 2
    mean = [F.col(f"m{a}") / k for a in "xyz"]
    return normal.withColumn("vrm", F.lit(1.0) - F.sqrt(sum((m * m for m in mean), F.lit(0.0)))).drop("_x", "_y", "_z", "mx", "my", "mz")


def dissection(df: DataFrame, band: str = "dem", size: int = 3) -> DataFrame:
    """(most - least) / most in a window: 0 where flat, NULL where the most is 0."""
    out = square(df, band, (size - 1) // 2, {"low": F.min, "high": F.max})
    return out.withColumn("dissection", F.when(F.col("high") == F.col("low"), 0.0).otherwise(div(F.col("high") - F.col("low"), F.col("high")))).drop("low", "high")


def erode_disk(df: DataFrame, mask: str, radius: int) -> DataFrame:
    """Cells of the mask with no invalid cell within a disk; what is outside the tile counts as valid."""
    bad = disk_sum(df.withColumn("_bad", F.when(F.col(mask), 0).otherwise(1)), "_bad", radius)
    return bad.withColumn("eroded", F.col("total") == 0).drop("_bad", "total", "cells")


def drop_edge(mask: Column, width: int, height: int, edge: int) -> Column:
    """The mask without a band of ``edge`` cells along the tile's sides; 0 takes nothing."""
    x, y = F.col("x"), F.col("y")
    return mask & ~((y < edge) | (y >= height - edge) | (x < edge) | (x >= width - edge))


def erode_square(df: DataFrame, mask: str, steps: int = 1, out: str = "eroded") -> DataFrame:
    """``steps`` erosions by 3x3: the whole square must be set, outside the tile is not."""
    rows, cols = along_row().rangeBetween(-steps, steps), along_column().rangeBetween(-steps, steps)
    return df.withColumn("_r", F.sum(F.col(mask).cast("int")).over(rows)).withColumn(out, F.sum("_r").over(cols) == (2 * steps + 1) ** 2).drop("_r")


def boundary(df: DataFrame, mask: str, width: int, height: int, ratio: float | int = 0.02) -> DataFrame:
    """Cells of the mask that erosion takes away; a share below 1 is of the diagonal (half-even, at least 1)."""
    steps = ratio if isinstance(ratio, int) else max(1, round(ratio * (width * width + height * height) ** 0.5))
    return erode_square(df, mask, steps).withColumn("boundary", F.col(mask) & ~F.col("eroded")).drop("eroded")


def buffer_cells(radius: float, resolution: float) -> int:
    """Cells to read around a tile so that a focal step of ``radius`` metres is whole inside it."""
    reach = radius / resolution * 2**0.5
    return int(-(-reach // 1))


def halo(cells: DataFrame, box: tuple[int, int, int, int], buffer: int) -> DataFrame:
    """Cells of a box (x0, y0, x1, y1; ends exclusive) and of a buffer around it."""
    x0, y0, x1, y1 = box
    return cells.where(F.col("x").between(x0 - buffer, x1 + buffer - 1) & F.col("y").between(y0 - buffer, y1 + buffer - 1))
