"""Spectral indices over bands clipped to [0, 1]; a zero denominator gives NULL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tesserae.functions.safe import clip, div

#: The formula of each index. ``b g r n`` are blue, green, red and near infrared, ``v`` is ``ndvi``.
FORMULAS = {
    "ndvi": lambda b, g, r, n, v: v,
    "gndvi": lambda b, g, r, n, v: clip(div(n - g, n + g), -1.0, 1.0),
    "grvi": lambda b, g, r, n, v: div(g - r, g + r),
    "rvi": lambda b, g, r, n, v: div(r, n),
    "nrvi": lambda b, g, r, n, v: div(div(r, n) - 1, div(r, n) + 1),
    "tvi": lambda b, g, r, n, v: F.when(v + 0.5 >= 0, F.sqrt(F.abs(v + 0.5))),
    "ctvi": lambda b, g, r, n, v: div(v + 0.5, F.abs(v + 0.5)) * F.sqrt(F.abs(v + 0.5)),
    "ttvi": lambda b, g, r, n, v: F.sqrt(F.abs(v) + 0.5),
    "savi": lambda b, g, r, n, v: v * 1.5,
    "evi": lambda b, g, r, n, v: div((n - r) * 2.5, n + r * 6 - b * 7.5 + 1),
    "vari": lambda b, g, r, n, v: div(g - r, g + r - b),
    "tgi": lambda b, g, r, n, v: ((r - g) * 190 - (r - b) * 120) * -0.5,
    "exg": lambda b, g, r, n, v: g * 2 - r - b,
}
ALIASES = {"vigreen": "grvi", "vdvi": "gli"}


def add_indices(pixels: DataFrame, names: list[str]) -> DataFrame:
    """``pixels`` with the named indices; an index that is there already is used as it is."""
    b, g, r, n = (clip(F.col(c), 0.0, 1.0) for c in ("blue", "green", "red", "nir"))
    ndvi = F.col("ndvi") if "ndvi" in pixels.columns else clip(div(n - r, n + r), -1.0, 1.0)
    made = {}
    for name in names:
        if name in pixels.columns:
            continue
        real = ALIASES.get(name, name)
        if real == "gli":  # the one index over bands as they are
            g0, r0, b0 = F.col("green"), F.col("red"), F.col("blue")
            made[name] = div(g0 * 2 - r0 - b0, g0 * 2 + r0 + b0)
        else:
            made[name] = FORMULAS[real](b, g, r, n, ndvi)
    return pixels.withColumns(made)


#: Formulas of common indices over the short names of bands and constants.
REGISTRY = (
    ("NDVI", "try_divide(N - R, N + R)", {}),
    ("GNDVI", "try_divide(N - G, N + G)", {}),
    ("NDWI", "try_divide(G - N, G + N)", {}),
    ("EVI", "try_divide(g * (N - R), N + C1 * R - C2 * B + L)", {"g": 2.5, "C1": 6.0, "C2": 7.5, "L": 1.0}),
    ("EVI2", "try_divide(g * (N - R), N + 2.4 * R + L)", {"g": 2.5, "L": 1.0}),
    ("SAVI", "try_divide((1 + L) * (N - R), N + R + L)", {"L": 0.5}),
    ("OSAVI", "try_divide(N - R, N + R + 0.16)", {}),
    ("DVI", "N - R", {}),
    ("SR", "try_divide(N, R)", {}),
    ("VARI", "try_divide(G - R, G + R - B)", {}),
    ("GLI", "try_divide(2 * G - R - B, 2 * G + R + B)", {}),
    ("ExG", "2 * G - R - B", {}),
    ("WDRVI", "try_divide(alpha * N - R, alpha * N + R)", {"alpha": 0.1}),
)
#: The short names that formulas use for bands.
BANDS = {"B": "blue", "G": "green", "R": "red", "N": "nir"}
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def registry_table(spark: SparkSession, entries: Sequence[tuple[str, str, Mapping[str, float]]] = REGISTRY) -> DataFrame:
    """A registry as a table: ``name, formula, constants``. Users give their own with more entries."""
    return spark.createDataFrame([(n, f, dict(c)) for n, f, c in entries], "name string, formula string, constants map<string,double>")


def registered_index(pixels: DataFrame, name: str, registry: DataFrame | None = None, **operands: Column | float) -> DataFrame:
    """The index that a registry table has under ``name``, as a column of that name in lower case."""
    rows = (registry_table(pixels.sparkSession) if registry is None else registry).where(F.col("name") == name).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} entries named {name} in the registry")
    return named_index(pixels, name.lower(), rows[0]["formula"], rows[0]["constants"], **operands)


def named_index(pixels: DataFrame, name: str, formula: str, constants: Mapping[str, float] | None = None, **operands: Column | float) -> DataFrame:
    """An index from a formula over names: given operands go before constants, those before clipped bands.

    A band goes by its column or by its short name. A missing operand gives NULL; a formula that can divide
    by zero says so with ``try_divide``.
    """
    bands = {c: c for c in pixels.columns if c in BANDS.values()} | {k: c for k, c in BANDS.items() if c in pixels.columns}
    constants = dict(constants or {})
    scope = {k: clip(F.col(c), 0.0, 1.0) for k, c in bands.items()} | {k: F.lit(v) for k, v in constants.items()} | {k: v if isinstance(v, Column) else F.lit(v) for k, v in operands.items()}
    used = [k for k in dict.fromkeys(_NAME.findall(formula)) if k in scope]
    if not any(isinstance(operands[k], Column) if k in operands else k not in constants for k in used):
        raise ValueError("an index needs at least one band")
    # fields go by number: names may differ in case alone
    packed = F.struct(*(scope[k].cast("double").alias(f"_{i}") for i, k in enumerate(used)))
    place = {k: f"_operands._{i}" for i, k in enumerate(used)}
    tokens = _NAME.sub(lambda m: place.get(m[0], m[0]), formula)
    return pixels.withColumn("_operands", packed).withColumn(name, F.expr(tokens)).drop("_operands")
