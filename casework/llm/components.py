"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.session import write_table


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """links (a long, b long) -> (node, root): root is the smallest node of the
    component; nodes without a link are left out.  Alternating large-star and
    small-star steps, each an aggregation with map-side combine and a join
    that adaptive execution may split at a hot node.  Every round is a written
    table, so a lost executor costs no more than one round."""
    def stars(at: DataFrame, both_ways: bool) -> DataFrame:
        near = at.union(at.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both_ways else at
        least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        moved = near.join(least, "a")
        if both_ways:  # larger neighbours go to the least
            return moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def mark(at: DataFrame):
        return at.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()

    # every link points from the larger node to the smaller
    now = write_table(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                      "links")
    seen = mark(now)
    for _ in range(rounds if seen["n"] else 0):
        now = write_table(stars(stars(now, True), False), "links")
        then, seen = seen, mark(now)
        if then == seen:
            break
    else:
        if seen["n"]:
            raise RuntimeError(f"components not settled after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
