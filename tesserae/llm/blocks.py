"""Arrow batches of texts as NumPy buffers, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def cuts(batches: Iterator[pa.RecordBatch], column: int | str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts hold at most ``limit`` bytes together; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins (one more than texts). Null is empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def texts(column: pa.Array) -> list[bytes]:
    """Each text's UTF-8 bytes. Null is empty."""
    return pc.fill_null(column, "").cast(pa.large_binary()).to_pylist()
