"""Structured Streaming form of the weekly incremental run.

A file source over the landing folder, drained with ``availableNow`` (the
weekly job), an event-time watermark, Monday-aligned 1-week windows
(``startTime='4 days'``: the epoch is a Thursday) and a ``foreachBatch``
sink that rewrites a Parquet result table in the shared checkpoint folder
(complete mode: every micro-batch carries the whole aggregate, so an
overwrite is idempotent and survives a lost executor or a restarted
query).  Re-running picks up only new files thanks to the source offsets
kept in the query checkpoint.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.session import ensure_checkpoint_dir, table_path
from casework.sources.adapter import interventions_from_events


def weekly_counts_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                         source_file: str = "events.parquet") -> DataFrame:
    """Drain the landing folder once and return the weekly count table
    (semana, estado, n) it maintains."""
    root = out_dir or os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    result_path = os.path.join(root, "weekly_counts")
    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    stream = (spark.readStream.schema(schema)
                   .option("pathGlobFilter", source_file)
                   .parquet(sf_dir))
    # event time as an instant whose UTC wall clock is the naive timestamp, so
    # the Monday-aligned windows do not move with the session time zone
    c = F.col("fecha_inicio")
    rows = interventions_from_events(stream).withColumn(
        "_ts", F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.second(c),
                                F.lit("UTC")))
    agg = (rows.withWatermark("_ts", "14 days")
               .groupBy(F.window("_ts", "1 week", startTime="4 days").alias("w"), "estado")
               .agg(F.count(F.lit(1)).alias("n")))

    def sink(batch: DataFrame, epoch: int) -> None:
        monday = F.date_add(F.lit("1970-01-01").cast("date"),
                            F.floor(F.unix_micros("w.start") / 86_400_000_000).cast("int"))
        (batch.select(monday.alias("semana"), "estado", F.col("n").cast("bigint"))
              .write.mode("overwrite").parquet(result_path))

    query = (agg.writeStream.outputMode("complete")
                .option("checkpointLocation", os.path.join(root, "checkpoint"))
                .foreachBatch(sink)
                .trigger(availableNow=True)
                .start())
    query.awaitTermination()
    return spark.read.parquet(result_path)
