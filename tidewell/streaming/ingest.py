"""Files to raw tables, each file once; and raw tables as change streams."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewell.sources.json_lines import LOADED, ledger, mark_malformed, note_load, positioned, unseen_files, with_position
from tidewell.sources.records import RAW_SCHEMA
from tidewell.streaming.publish import batch_folders, write_once

Handler = Callable[[DataFrame, int], None]


def batches(source: DataFrame, name: str, checkpoint: str, handle: Handler) -> DataStreamWriter:
    return source.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(handle)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process all that waits, then stop; without new files no batch runs."""
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return running


def run_every(writer: DataStreamWriter, interval: str = "1 minute") -> StreamingQuery:
    return writer.trigger(processingTime=interval).start()


def ingest_stream(
    spark: SparkSession, prefix: str, table: str, checkpoint: str, name: str,
    glob: str = "*.json.gz", files_per_batch: int | None = None,
) -> DataStreamWriter:
    """Append new files under a prefix to a raw table, malformed lines set aside.

    The checkpoint remembers file paths. Running it again picks up files that
    came before the stream was set up, and skips all that were loaded. Batches are
    named by the checkpoint's own id, so a rebuilt checkpoint starts anew beside the
    batches of the lost one; files that those hold are left out by their names in the ledger.
    """
    reader = (spark.readStream.format("text").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def handle(lines: DataFrame, batch_id: int) -> None:
        run = stream_id(spark, checkpoint)
        raw = positioned(lines).withColumn("ingested_at", F.current_timestamp())
        if batch_folders(spark, table, but=run):
            others = ledger(spark, table).filter(~F.col("load").startswith(run))
            raw = unseen_files(raw, others)
        load = f"{run}-{batch_id:012d}"
        write_once(mark_malformed(raw), table, load, ("load_status",))
        note_load(spark, table, load)

    return batches(with_position(reader.load(prefix)), name, checkpoint, handle)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint was made; it lasts as long as the checkpoint."""
    lines = spark.read.text(f"{checkpoint}/metadata").collect()
    return next(json.loads(r.value)["id"] for r in lines if r.value.startswith("{"))


def writer_id(spark: SparkSession, checkpoint: str, name: str) -> str:
    """Names the stream and its checkpoint, as batch numbers only mean something within one checkpoint."""
    return f"{name}:{stream_id(spark, checkpoint)}"


def raw_changes(spark: SparkSession, table: str, files_per_batch: int | None = None) -> DataFrame:
    """Loaded rows of a raw table as a stream of appends."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{table}/batch=*/load_status={LOADED}")
