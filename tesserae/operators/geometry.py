"""Geometry on arrays of points, map projections, and the grid of equal cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import pi

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The ellipsoid of GPS, the scale of UTM, the radius of the cell grid (km).
AXIS, FLATTENING, UTM_SCALE, RADIUS = 6378137.0, 1 / 298.257223563, 0.9996, 6378.137


def _pairs(ring: Column) -> Column:
    return F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin))


def area(ring: Column) -> Column:
    """Area of a closed ring."""
    return F.abs(F.aggregate(_pairs(ring), F.lit(0.0), lambda s, p: s + (p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]))) / 2


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a closed ring, by counting edges to its right."""
    crosses = lambda p: ((p["a"]["y"] > y) != (p["b"]["y"] > y)) & (x < (p["b"]["x"] - p["a"]["x"]) * (y - p["a"]["y"]) / F.nullif(p["b"]["y"] - p["a"]["y"], F.lit(0.0)) + p["a"]["x"])
    return F.aggregate(_pairs(ring), F.lit(0), lambda s, p: s + F.when(crosses(p), 1).otherwise(0)) % 2 == 1


def translate(ring: Column, dx: Column, dy: Column) -> Column:
    return F.transform(ring, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y")))


def crop(pixels: DataFrame, ring: Column, values: list[str] | None = None) -> DataFrame:
    """Cells of a ring's box; those whose centre lies outside the ring are left out, or, if ``values`` are named, stay
    with NULL in them. The box is a filter on ``y`` and ``x`` that reaches the scan."""
    at = lambda f, k: f(F.transform(ring, lambda p: p[k]))
    inside = contains(ring, F.col("x") + 0.5, F.col("y") + 0.5)
    near = pixels
    for c in ("x", "y"):
        near = near.where((F.col(c) + 0.5 >= at(F.array_min, c)) & (F.col(c) + 0.5 <= at(F.array_max, c)))
    return near.where(inside) if values is None else near.withColumns({v: F.when(inside, F.col(v)) for v in values})


def utm_zone(lat: Column, lon: Column) -> Column:
    """EPSG code of the UTM zone, with the zones that are wider about Norway and Svalbard."""
    plain = F.least(F.floor((lon + 180) / 6) + 1, F.lit(60))
    norway = (lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12)
    svalbard = (lat >= 72) & (lat < 84)
    zone = F.when(norway, 32).when(svalbard & (lon >= 0) & (lon < 9), 31).when(svalbard & (lon >= 9) & (lon < 21), 33).when(svalbard & (lon >= 21) & (lon < 33), 35).when(svalbard & (lon >= 33) & (lon < 42), 37).otherwise(plain)
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")


#: What makes two tiles the same grid.
GRID = ("crs", "x0", "y0", "res_x", "res_y", "width", "height")


def same_grid(grid: DataFrame, other: DataFrame, tile: str = "tile_id") -> None:
    """Fails if a tile that both tables have (a row each) differs in a column of ``GRID``; nulls equal nulls."""
    pairs = grid.select(tile, *GRID).join(other.select(tile, *(F.col(c).alias(f"r_{c}") for c in GRID)), tile)
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in GRID))
    bad = pairs.where(differs).select(tile).limit(3).collect()
    if bad:
        raise ValueError(f"tiles on another grid: {sorted(r[0] for r in bad)}")


def assemble(base: DataFrame, grid: DataFrame, layers: Sequence[tuple[DataFrame, DataFrame]], fill: dict | None = None, cell: Sequence[str] = ("tile_id", "y", "x")) -> DataFrame:
    """Every cell of ``base`` with the columns of each layer, NULL where a layer has no such cell, or its ``fill``.

    A layer comes with its tiles' grids; it has one row a cell at most, and may lack tiles, but those that it has must
    be on the grid of ``base``, or the job fails. Without layers ``base`` comes back. All joins are on the cell, so
    one exchange of ``base`` serves them. Columns that two layers share fail, as neither can be told from the other.
    """
    names = [c for c in base.columns if c not in cell]
    for cells, other in layers:
        fresh = [c for c in cells.columns if c not in cell]
        if both := sorted(set(names) & set(fresh)):
            raise ValueError(f"columns of several layers: {both}")
        names += fresh
        same_grid(grid, other, cell[0])
    for cells, _ in layers:
        base = base.join(cells, list(cell), "left")
    return base.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (fill or {}).items()})


def to_utm(lat: Column, lon: Column, epsg: Column) -> tuple[Column, Column]:
    """Easting and northing by Krueger's series to the third order."""
    n = FLATTENING / (2 - FLATTENING)
    big = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * n**0.5 / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - ((epsg % 100) * 6 - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - F.atanh(F.sin(phi) * e) * e)
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(t * t + 1))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    shift = F.when(epsg >= 32700, 1e7).otherwise(0.0)
    return east * (UTM_SCALE * big) + 500000.0, north * (UTM_SCALE * big) + shift


def from_utm(east: Column, north: Column, epsg: Column) -> tuple[Column, Column]:
    """Latitude and longitude of an easting and northing: the series of ``to_utm`` turned round, to the third order."""
    n = FLATTENING / (2 - FLATTENING)
    big = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi = (north - F.when(epsg >= 32700, 1e7).otherwise(0.0)) / (UTM_SCALE * big)
    eta = (east - 500000.0) / (UTM_SCALE * big)
    up, over = xi, eta
    for j, b in enumerate(beta, 1):
        up = up - F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b
        over = over - F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b
    chi = F.asin(F.sin(up) / F.cosh(over))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + F.sin(chi * (2 * j)) * d
    return F.degrees(phi), F.degrees(F.atan2(F.sinh(over), F.cos(up))) + ((epsg % 100) * 6 - 183)


def to_polar(lat: Column, lon: Column, true_lat: float = 70.0, centre: float = -45.0) -> tuple[Column, Column]:
    """North polar stereographic x and y."""
    from math import radians, sin, sqrt, tan

    e = sqrt(FLATTENING * (2 - FLATTENING))
    half = lambda phi: tan(pi / 4 - phi / 2) / ((1 - e * sin(phi)) / (1 + e * sin(phi))) ** (e / 2)
    c = radians(true_lat)
    m = (1 - sin(c) ** 2) ** 0.5 / (1 - e * e * sin(c) ** 2) ** 0.5
    phi, lam = F.radians(lat), F.radians(lon - centre)
    s = F.sin(phi) * e
    t = F.tan(F.lit(pi / 4) - phi / 2) / F.pow((F.lit(1.0) - s) / (s + 1), e / 2)
    rho = t * (AXIS * m / half(c))
    return rho * F.sin(lam), -rho * F.cos(lam)


def grid_index(name: Column) -> tuple[Column, Column]:
    """Row and column of a cell name such as ``12U34R``; down and left are negative."""
    part = lambda i: F.regexp_extract(name, r"^([0-9]+)([UD])([0-9]+)([LR])$", i)
    sign = lambda i, back: F.when(part(i) == back, -1).otherwise(1)
    row = F.when(part(1) != "", part(1).try_cast("int") * sign(2, "D"))
    return row, F.when(part(3) != "", part(3).try_cast("int") * sign(4, "L"))


def grid_rows(spark: SparkSession, d: float) -> DataFrame:
    """Rows of a grid of cells of ``d`` km: ``row, lat, height, n_cols, row_name``; the equator is 0U."""
    from math import ceil

    n = ceil(pi * RADIUS / d)
    rows = spark.range(n).select(F.col("id").cast("int").alias("i"))
    lat = F.col("i") * (180.0 / n) - 90.0
    zero = n // 2 if n % 2 == 0 else n // 2 + 1
    row = F.col("i") - zero
    cols = F.greatest(F.ceil(F.cos(F.radians(lat)) * (2 * pi * RADIUS / d)).cast("int"), F.lit(1))
    return rows.select(row.alias("row"), lat.alias("lat"), F.lit(180.0 / n).alias("height"), cols.alias("n_cols"), F.concat(F.abs(row), F.when(row < 0, "D").otherwise("U")).alias("row_name"))


def grid_row_of(lat: Column, d: float) -> Column:
    """Row of the cell of ``d`` km that a latitude lies in."""
    from math import ceil

    n = ceil(pi * RADIUS / d)
    return (F.floor((lat + 90) / (180.0 / n)) - (n // 2 if n % 2 == 0 else n // 2 + 1)).cast("int")


def grid_col_of(lon: Column, n_cols: Column) -> Column:
    """Column of the cell that a longitude lies in, in a row of ``n_cols`` cells."""
    return (F.floor((lon + 180) / (F.lit(360.0) / n_cols)) - F.floor(n_cols / 2)).cast("int")


def grid_cells(rows: DataFrame) -> DataFrame:
    """Cells of grid rows: ``row, col, name, lat, lon, height, width``; the prime meridian is 0L."""
    half = F.floor(F.col("n_cols") / 2).cast("int")
    cells = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1)))
    col = F.col("k") - half
    name = F.concat("row_name", F.abs(col), F.when(col <= 0, "L").otherwise("R"))
    width = F.lit(360.0) / F.col("n_cols")
    return cells.select("row", col.alias("col"), name.alias("name"), "lat", (F.col("k") * width - 180.0).alias("lon"), "height", width.alias("width"))


def grid_within(cells: DataFrame, south: float, west: float, north: float, east: float, ring: Column | None = None) -> DataFrame:
    """Cells whose south-west corner lies in the bounds, padded to the south by a cell's height and to the west by the
    width of the cells of its row; with a ring, those of them that have a corner inside it."""
    lat, lon, up, right = (F.col(c) for c in ("lat", "lon", "height", "width"))
    near = cells.where(((lat >= F.lit(south) - up) & (lat <= north)) & ((lon >= F.lit(west) - right) & (lon <= east)))
    if ring is None:
        return near
    corners = [contains(ring, lon + dx, lat + dy) for dx in (0.0, right) for dy in (0.0, up)]
    return near.where(corners[0] | corners[1] | corners[2] | corners[3])


def tile_extent(tiles: DataFrame) -> DataFrame:
    """Bounding box of each tile from its origin, resolution and size."""
    x1, y1 = F.col("x0") + F.col("width") * F.col("res_x"), F.col("y0") + F.col("height") * F.col("res_y")
    return tiles.select("tile_id", F.least("x0", x1).alias("xmin"), F.least("y0", y1).alias("ymin"), F.greatest("x0", x1).alias("xmax"), F.greatest("y0", y1).alias("ymax"))


def scanlines(rings: Column) -> Column:
    """``y, x0, x1`` of the runs of cells (``x1`` not included) whose centres lie in a polygon, by row.

    Each edge crosses the centre lines of its own rows; sorted by row and place, every second crossing ends a run. All
    rings count, so holes are left out.
    """
    cell = lambda v: F.ceil(v - 0.5).cast("int")  # noqa: E731  first cell whose centre is not before v

    def crossings(e: Column) -> Column:
        a, b = e["a"], e["b"]
        first, last = cell(F.least(a["y"], b["y"])), cell(F.greatest(a["y"], b["y"])) - 1
        rows = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        at = lambda y: (b["x"] - a["x"]) * (y + 0.5 - a["y"]) / (b["y"] - a["y"]) + a["x"]
        return F.transform(rows, lambda y: F.struct(y.alias("y"), at(y).alias("x")))

    every = F.sort_array(F.flatten(F.transform(F.flatten(F.transform(rings, _pairs)), crossings)))
    pairs = lambda c: F.when(F.size(c) > 1, F.sequence(F.lit(1), F.size(c) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    run = lambda c, i: F.struct(F.element_at(c, i)["y"].alias("y"), cell(F.element_at(c, i)["x"]).alias("x0"), cell(F.element_at(c, i + 1)["x"]).alias("x1"))
    runs = F.element_at(F.transform(F.array(every), lambda c: F.transform(pairs(c), lambda i: run(c, i))), 1)  # crossings are made once
    return F.filter(runs, lambda r: r["x0"] < r["x1"])


def polygon_runs(labels: DataFrame) -> DataFrame:
    """``tile_id, y, x0, x1`` of the cells in each polygon of ``tile_id, rings`` (cell coordinates), one row for a run."""
    return labels.select("tile_id", F.explode(scanlines(F.col("rings"))).alias("r")).select("tile_id", "r.*")


def rasterise(pixels: DataFrame, labels: DataFrame, extent: str, quality: str) -> DataFrame:
    """1 in a label polygon, 0 outside; 2 (to be ignored) outside the extent and where quality is not 2.

    ``labels`` has ``tile_id`` and ``ring``, or ``rings`` of polygons with holes, in cell coordinates; a cell's centre
    decides. Polygons become runs of rows, and a cell is inside if more runs of its row have begun than ended: neither a
    polygon's box nor its inside is made cell by cell. Equal polygons of a tile are walked once.
    """
    rings = labels if "rings" in labels.columns else labels.withColumn("rings", F.array("ring"))
    ends = F.array(F.struct(F.col("x0").alias("x"), F.lit(1).alias("_d")), F.struct(F.col("x1").alias("x"), F.lit(-1).alias("_d")))
    marks = polygon_runs(rings.select("tile_id", "rings").distinct()).select("tile_id", "y", F.explode(ends).alias("e")).groupBy("tile_id", "y", "e.x").agg(F.sum("e._d").alias("_d"))
    row = Window.partitionBy("tile_id", "y").orderBy("x", "_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = pixels.withColumns({"_cell": F.lit(1), "_d": F.lit(0).cast("long")}).unionByName(marks.withColumn("_cell", F.lit(0)), allowMissingColumns=True)
    inside = both.withColumn("_in", F.sum("_d").over(row)).where("_cell = 1")
    return inside.withColumn("label", F.when(~F.col(extent) | (F.col(quality) != 2), 2).otherwise((F.col("_in") > 0).cast("int"))).drop("_in", "_cell", "_d")


def resample(source: DataFrame, targets: DataFrame, value: str, scale: float, shift_x: float, shift_y: float, cubic: bool = False) -> DataFrame:
    """Another grid's values at the target cells: nearest, or Keys' cubic over 4 x 4 neighbours.

    Target cell (x, y) lies at ``x * scale + shift_x`` of the source grid; neighbours outside give no weight.
    The hint keeps the source, which is as large as the targets, from a broadcast by the size of its compressed file.
    """
    sx, sy = F.col("x") * scale + shift_x, F.col("y") * scale + shift_y
    if not cubic:
        near = targets.select("tile_id", "y", "x", F.floor(sx + 0.5).cast("int").alias("_x"), F.floor(sy + 0.5).cast("int").alias("_y"))
        return near.join(source.select("tile_id", F.col("y").alias("_y"), F.col("x").alias("_x"), value).hint("merge"), ["tile_id", "_y", "_x"], "left").drop("_x", "_y")

    def weight(t: Column) -> Column:
        t = F.abs(t)
        return F.when(t <= 1, t * t * t * 1.5 - t * t * 2.5 + 1).when(t < 2, t * t * t * -0.5 + t * t * 2.5 - t * 4 + 2).otherwise(0.0)

    near = targets.select("tile_id", "y", "x", sx.alias("_sx"), sy.alias("_sy"))
    near = near.withColumn("_y", F.explode(F.sequence(F.floor("_sy") - 1, F.floor("_sy") + 2))).withColumn("_x", F.explode(F.sequence(F.floor("_sx") - 1, F.floor("_sx") + 2)))
    near = near.withColumn("_w", weight(F.col("_sx") - F.col("_x")) * weight(F.col("_sy") - F.col("_y")))
    hit = near.join(source.select("tile_id", F.col("y").cast("long").alias("_y"), F.col("x").cast("long").alias("_x"), value).hint("merge"), ["tile_id", "_y", "_x"])
    total = F.sum("_w")
    return hit.groupBy("tile_id", "y", "x").agg(F.try_divide(F.sum(F.col("_w") * F.col(value)), total).alias(value))
