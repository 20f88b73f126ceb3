"""Band codecs: storage, memory and model representations of a band."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tesserae.functions.safe import clip

#: The whole numbers that a storage type holds.
RANGES = {"bool": (0, 1), "uint8": (0, 255), "int8": (-128, 127), "uint16": (0, 65535), "int16": (-32768, 32767), "uint32": (0, 4294967295), "int32": (-2147483648, 2147483647)}


@dataclass(frozen=True)
class Codec:
    band: str
    disk: str
    vmin: float
    vmax: float
    scale: float | None = None
    offset: float | None = None
    fill: int | None = None


def _optical(band: str) -> Codec:
    return Codec(band, "uint16", -0.1, 0.5, 1e-4, -0.1, 0)


#: How each known band is stored.
CODECS = (
    *map(_optical, ("blue", "green", "red", "nir")),
    Codec("ndvi", "int16", -1.0, 1.0, 1e-4, -1.0, -1),
    Codec("probabilities", "uint8", 0.0, 1.0, 1e-2, 0.0, 255),
    Codec("probabilities-*", "uint8", 0.0, 1.0, 1e-2, 0.0, 255),
    Codec("tc_brightness", "uint8", 0, 255),
    Codec("tc_greenness", "uint8", 0, 255),
    Codec("tc_wetness", "uint8", 0, 255),
    Codec("s2_scl", "uint8", 0, 11),
    Codec("quality_data_mask", "uint8", 0, 2),
    Codec("binarized_segmentation", "bool", 0, 1),
    Codec("binarized_segmentation-*", "bool", 0, 1),
    Codec("dem", "int16", -100.0, 3000.0, 0.1, -100.0, -1),
    Codec("relative_elevation", "int16", -50.0, 50.0, 100 / 30000, -50.0, -1),
    Codec("slope", "int16", 0.0, 90.0, 1e-2, 0.0, -1),
    Codec("aspect", "int16", 0.0, 360.0, 1e-1, 0.0, -1),
    Codec("hillshade", "int16", 0.0, 1.0, 1e-4, 0.0, -1),
    Codec("curvature", "int16", -1.0, 1.0, 1e-4, -1.0, -1),
    Codec("planet_udm", "uint8", 0, 8),
    Codec("arcticdem_data_mask", "bool", 0, 1),
    Codec("extent", "bool", 0, 1),
)


def lookup(band: str, codecs=CODECS) -> Codec | None:
    """By name, then by wildcard."""
    return next((c for c in codecs if c.band == band), None) or next((c for c in codecs if "*" in c.band and fnmatchcase(band, c.band)), None)


def as_table(spark: SparkSession, codecs=CODECS) -> DataFrame:
    schema = "band string, disk string, vmin double, vmax double, scale double, offset double, fill double"
    return spark.createDataFrame([tuple(float(v) if isinstance(v, (int, float)) else v for v in asdict(c).values()) for c in codecs], schema)


def lookup_table(bands: DataFrame, codecs: DataFrame) -> DataFrame:
    """Each band's codec; an exact name goes before a wildcard."""
    named = codecs.select(F.col("band").alias("pattern"), F.rtrim(F.col("band"), F.lit("*")).alias("start"), F.col("band").endswith("*").alias("open"))
    fits = (F.col("name") == F.col("pattern")) | (F.col("open") & F.col("name").startswith(F.col("start")))
    hit = bands.join(F.broadcast(named), fits, "left")  # codecs: one row for each known band
    return hit.groupBy("name").agg(F.min(F.struct(F.col("pattern").contains("*").alias("wild"), F.col("pattern"))).alias("best")).select("name", F.col("best.pattern").alias("codec"))


def encode(value: Column, codec: Codec) -> Column:
    if codec.scale is None:
        return value.cast("int")
    return F.coalesce(F.bround((value - codec.offset) / codec.scale).cast("int"), F.lit(codec.fill))


def decode(stored: Column, codec: Codec) -> Column:
    if codec.scale is None:
        return stored
    kept = stored != codec.fill if codec.fill is not None else F.lit(True)
    return F.when(kept, stored * codec.scale + codec.offset)


def normalise(value: Column, codec: Codec | None) -> Column:
    if codec is None:
        raise ValueError("no codec for this band")
    return clip(F.coalesce((value.cast("double") - codec.vmin) / (codec.vmax - codec.vmin), F.lit(0.0)), 0.0, 1.0)


def crop(value: Column, codec: Codec) -> Column:
    return clip(value, codec.vmin, codec.vmax)


def faults(codecs: DataFrame) -> DataFrame:
    """Codecs that break a rule, with the reason; one row for each fault."""
    low = F.create_map(*(F.lit(x) for k, v in RANGES.items() for x in (k, float(v[0]))))
    high = F.create_map(*(F.lit(x) for k, v in RANGES.items() for x in (k, float(v[1]))))
    at = lambda v: F.when(F.col("scale").isNull(), v).otherwise((v - F.col("offset")) / F.col("scale"))
    reasons = F.array(
        F.when(F.col("scale").isNull() != F.col("offset").isNull(), "scale and offset go together"),
        F.when(F.col("fill").isNotNull() & F.col("scale").isNull(), "only scaled bands have a fill value"),
        F.when((F.bround(at(F.col("vmin"))) < low[F.col("disk")]) | (F.bround(at(F.col("vmax"))) > high[F.col("disk")]), "range does not fit the storage type"),
        F.when(F.col("vmin") >= F.col("vmax"), "empty range"),
    )
    return codecs.select("band", F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason"))
