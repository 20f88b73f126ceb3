"""New scenes as they arrive: each is handled once, and a restart goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def scene_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def unique_scenes(stream: DataFrame, key: str | Sequence[str] = "scene_id", time: str = "ts", late: str = "30 days") -> DataFrame:
    """Each scene once; a repeat that comes later than ``late`` is dropped by the ledger instead."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key] if isinstance(key, str) else list(key))


def ingest(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, ledger: str, checkpoint: str, key: str = "scene_id"):
    """Handle every new scene (a row each) that is there, then stop; of rows with one key one is taken. Results and ledger are written by batch; a batch that runs
    again overwrites its own part, so nothing is written twice."""

    def batch(rows: DataFrame, number: int) -> None:
        fresh = rows.dropDuplicates([key])
        try:
            done = rows.sparkSession.read.parquet(ledger).where(F.col("batch") != number)
            fresh = fresh.join(done.select(key), key, "left_anti")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        fresh = fresh.persist()
        work(fresh).write.mode("overwrite").parquet(f"{out}/batch={number}")
        fresh.select(key, F.lit("success").alias("status")).write.mode("overwrite").parquet(f"{ledger}/batch={number}")
        fresh.unpersist()

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(stream: DataFrame, time: str = "ts", width: str = "1 day", late: str = "2 days", by: str = "grid_code") -> DataFrame:
    """Scenes by time window and grid code; windows close once the watermark has passed them."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))


def tiles_from_bands(stream: DataFrame, bands: Sequence[str], late: str = "30 days", patience_ms: int = 30 * 86_400_000, key: str = "scene_id", band: str = "band", time: str = "ts") -> DataFrame:
    """``key, status, missing``: a tile is handed on once all of its bands are there, in whatever batches they come.

    What a tile has so far is state by its key. A band that comes again changes nothing, also after the tile is
    complete. A tile that waits for longer than ``patience_ms`` after its latest band gives one row with the status
    ``missing`` and the bands that it lacks; its state ends then, as that of complete tiles does.
    """
    need = tuple(bands)

    def step(keys: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        row = lambda status, lacks: pd.DataFrame({key: [keys[0]], "status": [status], "missing": [",".join(b for b in need if b in lacks)]})
        seen, done, latest = state.get if state.exists else ("", False, 0)
        there = set(seen.split(",")) - {""}
        if state.hasTimedOut:
            state.remove()
            if not done:
                yield row("missing", set(need) - there)
            return
        for part in parts:
            there |= set(part[band]) & set(need)
            latest = max(latest, int(part[time].max().value // 1_000_000))
        if not done and len(there) == len(need):
            done = True
            yield row("complete", set())
        state.update((",".join(sorted(there)), done, latest))
        state.setTimeoutTimestamp(max(latest + patience_ms, state.getCurrentWatermarkMs() + 1))

    kind = stream.schema[key].dataType.simpleString()
    grouped = stream.withWatermark(time, late).select(key, band, time).groupBy(key)
    return grouped.applyInPandasWithState(step, f"`{key}` {kind}, status string, missing string", "seen string, done boolean, latest long", "append", "EventTimeTimeout")
