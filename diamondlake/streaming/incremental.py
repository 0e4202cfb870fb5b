"""Pitch layer fed by a folder of landed documents, in any split over files and batches.

Every micro-batch updates the same versioned layer as a batch run (``jobs.collect_pitches``):
games with documents the layer does not know are parsed anew from all their documents so
far. So innings that arrive apart are never lost, counters run over the whole game, and the
cut after an empty inning sees every inning. A batch that is repeated after a failure brings
nothing the layer does not know. Folders are merged as they gather, so a reader and a batch
open a bounded number of them, however many batches there were.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from diamondlake.plans.jobs import collect_pitches
from diamondlake.schemas import PITCH, RELAY_DOCUMENT
from diamondlake.sources.layers import PITCHES, REJECTS, read_pitch_layer
from diamondlake.sources.relay import from_raw_files
from diamondlake.sources.snapshots import BUCKETS, MOST, vacuum


def stream_documents(spark: SparkSession, path: str, files_per_batch: int = 1000, raw_files: bool = False) -> DataFrame:
    """Landed documents: JSON lines, or with ``raw_files`` one payload per ``<game_id>_<inning>.json``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if raw_files:
        files = reader.option("wholetext", True).text(path)
        return from_raw_files(files.select("value", F.col("_metadata.file_name").alias("name")))
    return reader.schema(RELAY_DOCUMENT).json(path)


def store_batch(documents: DataFrame, batch: int, out: str, buckets: int = BUCKETS, most: int = MOST) -> None:
    """Bring the layer up to date with a batch; folders that no recent version refers to go."""
    made = collect_pitches(documents.select(*RELAY_DOCUMENT.names), f"{out}/rows", buckets=buckets, most=most)
    if made.version:
        vacuum(documents.sparkSession, f"{out}/rows")


def read_stream_layer(spark: SparkSession, out: str, kind: str = PITCHES) -> DataFrame:
    """Every game as all its documents so far make it; ``kind`` is pitches or rejects."""
    return read_pitch_layer(spark, f"{out}/rows", kind)


def read_pitches(spark: SparkSession, out: str) -> DataFrame:
    return read_stream_layer(spark, out).select(*PITCH.names)


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    return read_stream_layer(spark, out, REJECTS)


def start_pitch_stream(
    spark: SparkSession, path: str, out: str, checkpoint: str, files_per_batch: int = 1000, raw_files: bool = False
) -> StreamingQuery:
    """Process everything landed so far and stop; run again for what lands later."""
    documents = stream_documents(spark, path, files_per_batch, raw_files)
    writer = documents.writeStream.foreachBatch(partial(store_batch, out=out))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
