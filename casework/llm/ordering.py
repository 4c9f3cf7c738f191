"""Global order, running totals and neighbours of a whole table, without a
window over all its rows.

A table is range-partitioned and sorted once, and written with the number of
its partition (``part``) and of the row in it (``at``).  Whatever runs across
partitions then needs one row a partition, or one a partition and key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casework.llm.common import shuffle_partitions
from casework.session import write_table

_IN_PART = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below


def in_order(rows: DataFrame, by: list[Column], name: str, keep: list[str] | None = None) -> DataFrame:
    """The rows, written in order of ``by``, with ``part`` and ``at``; of their
    columns those to ``keep``, or all."""
    placed = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    return write_table(placed.select(*(keep or rows.columns)).withColumn("part", F.spark_partition_id())
                       .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PART))), name)


def numbered(table: DataFrame, as_name: str) -> DataFrame:
    """Position of every row of an ``in_order`` table, from 0."""
    counts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    base = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return table.join(F.broadcast(base), "part").withColumn(as_name, F.col("base") + F.col("at")).drop("base")


def running(table: DataFrame, totals: dict[str, Column], merge: Callable[[Column], Column] = F.sum,
            key: str | None = None) -> DataFrame:
    """An ``in_order`` table with running totals up to and including each row,
    within ``key`` if given (the order must begin with it).  ``merge`` makes a
    total of values, and of totals: a sum, or exclusive or."""
    keys = ["part"] + ([key] if key else [])
    named = table.select("*", *[v.alias(k) for k, v in totals.items()])
    parts = named.groupBy(*keys).agg(*[merge(F.col(k)).alias(k) for k in totals])
    before = (Window.partitionBy(key) if key else Window).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select(*keys, *[F.coalesce(merge(F.col(k)).over(before), zero).alias(f"{k}_before") for k in totals])
    here = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    named = named.select(*table.columns, *[merge(F.col(k)).over(here).alias(k) for k in totals])
    if key:
        parts = parts.withColumnsRenamed({"part": "part_before", key: "key_before"})
        joined = named.join(parts, (F.col("part") == F.col("part_before")) & F.col(key).eqNullSafe(F.col("key_before")))
    else:
        joined = named.join(F.broadcast(parts), "part")  # one row a partition

    def with_before(k: str) -> Column:
        if merge is F.sum:
            return F.col(k) + F.col(f"{k}_before")
        return F.col(k).bitwiseXOR(F.col(f"{k}_before"))

    return joined.select(*table.columns, *[with_before(k).alias(k) for k in totals])


def with_next(table: DataFrame, columns: list[str]) -> DataFrame:
    """An ``in_order`` table with next_<column>: that of the next row."""
    firsts = table.groupBy("part").agg(*[F.min_by(c, "at").alias(f"first_{c}") for c in columns])
    over = Window.orderBy("part")  # one row a partition
    following = firsts.select("part", *[F.lead(f"first_{c}").over(over).alias(f"after_{c}") for c in columns])
    here, last = Window.partitionBy("part").orderBy("at"), F.lead(F.lit(1)).over(Window.partitionBy("part").orderBy("at")).isNull()
    led = table.select("*", last.alias("last_here"), *[F.lead(c).over(here).alias(f"next_{c}") for c in columns])
    return led.join(F.broadcast(following), "part").select(
        *table.columns, *[F.when(F.col("last_here"), F.col(f"after_{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}")
                          for c in columns])
