"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tesserae.llm.blocks import cuts

UNDETERMINED = "und"
_letter = regex.compile(r"\p{L}").search


def subwords(text: str, buckets: int) -> np.ndarray:
    """Hashed 3- and 4-byte subwords of the lower-cased text, with a space as the edge of words."""
    data = np.frombuffer(b" " + text.lower().encode() + b"    ", np.uint8).astype(np.uint32)
    three = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16
    four = three | data[3:] << 24
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    return np.concatenate([(three * np.uint32(2654435761)) >> shift, (four * np.uint32(2246822519)) >> shift])


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # of each bucket: its embedding times the output layer
    temperature: float
    accept: float  # scores below it are rejected

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score in [0, 1], and whether the score is high enough."""
        if not self.languages or not _letter(text):
            return UNDETERMINED, 0.0, False
        ids = subwords(text, len(self.logits))
        z = (np.bincount(ids, minlength=len(self.logits)) @ self.logits) / len(ids) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] >= self.accept)


def train(
    texts: list[str],
    languages: list[str],
    buckets: int = 1 << 13,
    dim: int = 16,
    epochs: int = 30,
    rate: float = 20.0,
    reject: float = 0.001,
    seed: int = 7,
) -> LanguageModel:
    """Fit by mini-batch stochastic gradient descent; a fifth of the rows sets temperature and threshold.

    ``reject`` is the share of rightly recognised calibration rows that the threshold may turn away. Without rows
    the model answers ``und``.
    """
    names = sorted(set(languages))
    kept = [(t, names.index(lang)) for t, lang in zip(texts, languages) if _letter(t)]
    if not kept:
        return LanguageModel([], np.zeros((buckets, 0)), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    x = np.zeros((len(kept), buckets), np.float32)
    for row, (text, _) in zip(x, kept):
        ids = subwords(text, buckets)
        row += np.bincount(ids, minlength=buckets) / len(ids)
    y = np.array([k for _, k in kept])
    order = rng.permutation(len(kept))
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    embed = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, len(names))).astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for at in range(0, len(fit), 64):
            rows = rng.choice(fit, min(64, len(fit)), replace=False)
            hidden = x[rows] @ embed
            z = hidden @ out
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = p @ out.T
            out -= step * 0.05 * (hidden.T @ p)
            embed -= step * (x[rows].T @ back)
    logits = (embed @ out).astype(np.float64)
    check = held if len(held) >= 20 else order
    z = x[check] @ logits

    def scores(t: float) -> np.ndarray:
        p = np.exp((z - z.max(1, keepdims=True)) / t)
        return p / p.sum(1, keepdims=True)

    loss = lambda t: -np.log(np.maximum(scores(t)[np.arange(len(check)), y[check]], 1e-9)).mean()
    best = min(np.geomspace(0.02, 5, 40), key=loss)
    p = scores(best)
    right = p.argmax(1) == y[check]
    accept = float(np.quantile(p.max(1)[right], reject)) if right.any() else 0.0
    return LanguageModel(names, logits, float(best), min(accept, 0.5))


def sample_rows(rows: DataFrame, key: str, most: int) -> DataFrame:
    """``most`` rows at most, those first in an order by a hash of the key: the same however the table is dealt out."""
    there = rows.count()
    share = min(1.0, 1.2 * most / max(there, 1))
    h = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    return rows.where(F.pmod(h, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(h, key).limit(most)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_rows: int = 2400) -> LanguageModel:
    """Train on a bounded sample (``max_rows``, chosen by hash) of the rows with a language."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    got = sample_rows(known, key, max_rows).select(F.col(text).cast("string"), F.col(lang).cast("string")).collect()
    got.sort(key=lambda r: (r[1], r[0]))
    return train([r[0] for r in got], [r[1] for r in got])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, lang_pred, score, accepted`` for every row, from the text alone.

    Null texts and texts without a letter get ``und``, score 0 and are not accepted; so does every row if the model
    was fitted on nothing. Repeated rows each get their own answer. Other columns are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cuts(batches, "text", 4 << 20):
            found = [model.predict(t) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                names=["key", "lang_pred", "score", "accepted"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double, accepted boolean").withColumnRenamed("key", key)


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language the model accepts."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cuts(batches, place, 4 << 20):
            yield block.filter(pa.array([model.predict(t or "")[2] for t in block.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
