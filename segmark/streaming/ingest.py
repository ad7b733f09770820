"""Incremental raw-order load (S2 + S3 as a stream).

CSV files of a landing stage go into the raw table: malformed rows abort, '' / 'NULL' become
NULL, ``_loaded_at`` is stamped, and a scheduled rerun picks up new files. A Structured
Streaming file source does that with an
``availableNow`` trigger: every run loads exactly the files not loaded before (the
checkpoint records them), in parallel across the cluster, then stops. The checkpoint
must live in shared storage so that a rerun on any driver resumes from it.
"""
from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmark.functions.scalar import typed_null
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from segmark.operators.incremental import merge_load
from segmark.operators.staging import stage_orders
from segmark.sources.raw import RAW_COLUMNS, RAW_SCHEMA


def raw_order_stream(spark: SparkSession, landing: str, strict: bool = True, max_files: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.csv(landing)
    cleaned = stream.select(
        *[F.when(F.col(c).isin("", "NULL"), typed_null("string")).otherwise(F.col(c)).alias(c) for c in RAW_COLUMNS]
    )
    # current_timestamp() in a stream is the micro-batch time: the load time of the batch.
    return cleaned.withColumn("_loaded_at", F.current_timestamp())


def start_ingest(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, strict: bool = True, max_files: int | None = None
) -> StreamingQuery:
    """``max_files`` splits a backlog into micro-batches of at most that many files."""
    return (
        raw_order_stream(spark, landing, strict, max_files)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(bronze)
    )


class _RowCounter(StreamingQueryListener):
    """Rows of every micro-batch of one query; progress reports keep only the last hundred."""

    def __init__(self) -> None:
        self.rows: dict[str, dict[int, int]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.setdefault(str(p.runId), {})[p.batchId] = p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def ingest_new_files(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, strict: bool = True, max_files: int | None = None
) -> int:
    """Load the files that arrived since the last run; returns the rows loaded in all batches."""
    counter = _RowCounter()
    spark.streams.addListener(counter)
    try:
        q = start_ingest(spark, landing, bronze, checkpoint, strict, max_files)
        run = str(q.runId)
        q.awaitTermination()
        until = time.monotonic() + 30  # reports arrive in order; the end of the run is the last one
        while run not in counter.ended and time.monotonic() < until:
            time.sleep(0.01)
    finally:
        spark.streams.removeListener(counter)
    if run not in counter.ended:
        raise RuntimeError("the stream ended without reporting its batches")
    return sum(counter.rows.get(run, {}).values())


def merge_new_files(spark: SparkSession, landing: str, state: str, checkpoint: str, strict: bool = True, max_files: int | None = None) -> None:
    """Merge the files that arrived since the last run into the feature state below ``state``.

    Each micro-batch is one load, numbered by its batch id: a batch that is run again after a failure
    is skipped if its load was committed, so every file counts once.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_load(batch.sparkSession, state, stage_orders(batch.drop("_loaded_at")), number)

    stream = raw_order_stream(spark, landing, strict, max_files).writeStream.foreachBatch(merge)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
