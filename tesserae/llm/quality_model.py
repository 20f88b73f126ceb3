"""Quality by compression: dictionaries of good and bad text, and a calibrated difference of compressed sizes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F

from tesserae.llm.blocks import cuts, texts
from tesserae.llm.langid import sample_rows

#: Bytes that are compressed together; a long text is the sum of such parts, so the dictionaries count throughout.
PART = 2048


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    level: int = 3

    def compressors(self) -> list[zstd.ZstdCompressor]:
        made = []
        for data in (self.good, self.bad):
            d = zstd.ZstdCompressionDict(data)
            d.precompute_compress(level=self.level)
            made.append(zstd.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
        return made

    def score(self, diff: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * diff + self.offset, -30, 30))))


def difference(text: bytes, good: zstd.ZstdCompressor, bad: zstd.ZstdCompressor) -> float:
    """(bad size - good size) / (bad size + good size) over all parts of the text; 0 for an empty one."""
    g = b = 0
    for at in range(0, len(text), PART):
        part = text[at : at + PART]
        g += len(good.compress(part))
        b += len(bad.compress(part))
    return (b - g) / (b + g) if b + g else 0.0


def _dictionary(samples: list[bytes], size: int) -> bytes:
    parts = [t[at : at + PART] for t in samples for at in range(0, len(t), PART)]
    try:
        return zstd.train_dictionary(size, parts, k=64, d=8).as_bytes()
    except zstd.ZstdError:  # too few samples for statistics: the text itself serves
        return b"".join(parts)[-size:]


def train(samples: list[bytes], labels: list[int], dict_bytes: int = 48 << 10) -> QualityModel:
    """Dictionaries from two thirds of each class, calibration (logistic, Newton's method) on the last third.

    With one class or none, the score is the share of label 1 (0.5 without rows).
    """
    share = (sum(labels) + 1) / (len(labels) + 2)
    flat = QualityModel(b"", b"", 0.0, float(np.log(share / (1 - share))) if labels else 0.0)
    classes = [[t for t, y in zip(samples, labels) if y == k and t] for k in (1, 0)]
    if min(map(len, classes)) < 3:
        return flat
    model = QualityModel(*(_dictionary([t for i, t in enumerate(c) if i % 3], dict_bytes) for c in classes), 0.0, 0.0)
    good, bad = model.compressors()
    rest = [(difference(t, good, bad), y) for y, c in zip((1, 0), classes) for i, t in enumerate(c) if i % 3 == 0]
    x, y = (np.array(v, float) for v in zip(*rest))
    weight = np.where(y == 1, sum(labels) / max(1, y.sum()), (len(labels) - sum(labels)) / max(1, (1 - y).sum()))
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, gradient)
    model.slope, model.offset = float(beta[0] / scale), float(beta[1])
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", max_rows: int = 1500) -> QualityModel:
    """Train on at most about ``max_rows`` labelled rows of each class, chosen by a hash of the key.

    A key with several labels counts once, with the greatest; labels other than 0 and 1, and null keys, do not count.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    chosen = None
    for k in (0, 1):
        part = sample_rows(known.where(F.col("label") == k), "key", max_rows)
        chosen = part if chosen is None else chosen.union(part)
    wanted = F.broadcast(chosen)  # 4 * max_rows rows at most
    got = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(wanted, "key").where("text IS NOT NULL").collect()
    got.sort(key=lambda r: (r["key"], r["text"]))
    return train([r["text"].encode() for r in got], [int(r["label"]) for r in got])


def score(docs: DataFrame, model: QualityModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, size_difference, score`` for every row; null counts as empty, whose difference is 0."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors() if model.good else None
        for block in cuts(batches, "text", 4 << 20):
            found = [difference(t, *pair) if pair else 0.0 for t in texts(block.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(found, pa.float64()), pa.array([model.score(f) for f in found], pa.float64())],
                names=["key", "size_difference", "score"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, size_difference double, score double").withColumnRenamed("key", key)
