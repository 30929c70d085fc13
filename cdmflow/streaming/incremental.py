"""Registry exports that arrive over time, loaded as a Structured Streaming job.

The reference appends every export with more ``INSERT`` statements whose ids come from
sequences. Here new export files in a folder are picked up by a file stream;
``foreachBatch`` loads each micro-batch with the same plan as the batch load, with ids
continuing after the rows of all *earlier* batches. Every batch writes its rows into its
own ``_batch=<id>`` folder with ``overwrite``, so a replayed batch (after a failure)
replaces its own output instead of duplicating it: exactly-once tables on an
at-least-once sink.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import id_bounds
from ..operators.rules import EVENT_TARGETS
from ..plans.etl import (EVENT_ID, build_spine, event_spine, event_table, key_events, load_observation_period,
                         load_person, split_records, visit_from_period)
from ..session import path_exists
from ..sources.dictionary import rename_labels
from ..sources.registry import clean_export, read_registry_text, type_registry

BATCH_COL = "_batch"


def batch_path(root: str, table: str, batch_id: int) -> str:
    return os.path.join(root, "omop", table, f"{BATCH_COL}={batch_id}")


def read_batched(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    path = os.path.join(root, "omop", table)
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path)


def _next_id(spark: SparkSession, root: str, table: str, key: str, batch_id: int) -> int:
    """1 + max id over batches before ``batch_id`` (a single number to the driver)."""
    df = read_batched(spark, root, table)
    if df is None:
        return 1
    mx = df.where(F.col(BATCH_COL) < batch_id).agg(F.max(key)).first()[0]
    return 1 + (mx or 0)


def load_registry_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Load one micro-batch (label-headed text columns) into the batch-partitioned CDM tables."""
    _load(type_registry(rename_labels(clean_export(batch))), batch_id, root)


def load_registry_files(spark: SparkSession, files: list[str], batch_id: int, root: str) -> None:
    """Load export files, each read by its own header."""
    _load(type_registry(read_registry_text(spark, files)), batch_id, root)


def _load(registry: DataFrame, batch_id: int, root: str) -> None:
    spark = registry.sparkSession
    if registry.isEmpty():
        return
    earlier = read_batched(spark, root, "person")
    known = None if earlier is None else earlier.where(F.col(BATCH_COL) < batch_id).select("person_source_value")
    accepted, refused = split_records(registry, known)
    start = _next_id(spark, root, "person", "person_id", batch_id)
    spine = build_spine(accepted, start=start, file_position=True)
    person = load_person(spine)
    period = load_observation_period(person)
    tables = {"person": person, "observation_period": period, "visit_occurrence": visit_from_period(period)}
    events = event_spine(spine)
    bounds = id_bounds(spine, "person_id")
    for target in EVENT_TARGETS:
        first = _next_id(spark, root, target, EVENT_ID[target], batch_id)
        tables[target] = event_table(key_events(events, target, start=first, bounds=bounds), target)
    tables["refused_records"] = refused.select(F.col("record_id").cast("string").alias("record_id"), "reason")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(batch_path(root, name, batch_id))


def start_registry_stream(spark: SparkSession, input_dir: str, root: str, checkpoint: str | None = None,
                          max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Watch ``input_dir`` for registry CSV exports and load each micro-batch.

    The stream carries only the names of new files: every export is read inside its batch by its own header, so a later
    export may order, leave out or add columns. Records without an id, with a repeated or an already loaded one are
    written to ``refused_records``.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(input_dir).select("path")
    inbox = hashlib.sha256(input_dir.rstrip("/").encode()).hexdigest()[:16]
    cp = checkpoint or os.path.join(root, "_stream_checkpoint", inbox)  # one per (inbox, root)

    def load(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.collect()]  # the new files of one trigger
        if files:
            load_registry_files(batch.sparkSession, files, batch_id, root)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", cp)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
