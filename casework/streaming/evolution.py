"""Streaming form of the carried per-person state (T01 + T04).

Each micro-batch of landing rows (a weekly drop) is cleaned, labelled against
the person state, and committed to a ``Store``: labelled rows, snapshot and
state delta become visible in one version, which also holds the epoch.  The
query checkpoint gives at-least-once delivery; a micro-batch that is replayed
after its commit is left out, one that failed before it starts over from the
same version, so every drop counts exactly once.

A drop writes only the state buckets of its ids and reads those alone; buckets
of many deltas are folded now and then.  Everything lives under the shared
checkpoint folder, never on a machine-local path.  The per-batch work is that
of the weekly job: one aggregation over the ids' buckets plus the batch, no
Python per group.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from casework.operators.geo import ZoneIndex
from casework.plans.jobs import compact_state, weekly_drop
from casework.session import ensure_checkpoint_dir, table_path
from casework.sources.adapter import interventions_from_events
from casework.sources.store import Store


def evolution_stream(spark: SparkSession, sf_dir: str, root: str | None = None, fuzzy: bool = True,
                     source_file: str = "events.parquet", files_per_trigger: int | None = None,
                     schema=None, zones: ZoneIndex | None = None) -> DataFrame:
    """Drain the landing folder (``availableNow``) and return the labelled
    history the stream maintains; ``files_per_trigger`` makes each landing
    file its own micro-batch (one weekly drop per trigger)."""
    root = root or os.path.join(ensure_checkpoint_dir(spark), f"evolution-stream-{uuid.uuid4().hex}")
    schema = schema or spark.read.parquet(table_path(sf_dir, "events")).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", source_file)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = interventions_from_events(reader.parquet(sf_dir))

    def run(batch: DataFrame, epoch: int) -> None:
        store = Store(batch.sparkSession, root)
        if store.manifest()["meta"].get("epoch", -1) >= epoch:
            return  # replayed after its commit
        weekly_drop(batch, store, fuzzy=fuzzy, zones=zones, meta={"epoch": epoch})
        compact_state(store)

    query = (rows.writeStream
                 .option("checkpointLocation", os.path.join(root, "checkpoint"))
                 .foreachBatch(run)
                 .trigger(availableNow=True)
                 .start())
    query.awaitTermination()
    return Store(spark, root).read("history").drop("week")
