"""Incremental ingestion as a file stream (K02, K04, J04, section 2.14 of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessella.sources.sinks import load_collection


def stream_chunks(spark: SparkSession, folder: str, schema: str, key: str = "chunk_id", event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """New JSON files as rows, one per key. With an event time the keys' state ends with the watermark; without it, it grows."""
    rows = spark.readStream.schema(schema).json(folder).where(f"{key} IS NOT NULL")
    if event_time:
        return rows.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, key: str = "chunk_id") -> StreamingQuery:
    """Each micro-batch is upserted into the collection; replays of a batch change nothing."""

    def write(batch: DataFrame, _: int) -> None:
        load_collection(batch.sparkSession, batch, path, key, force=True)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
