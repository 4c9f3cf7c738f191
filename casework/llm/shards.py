"""Resharding by minimum-cost flow (operator 4).

Old shards hold bytes, new shards have capacities.  The flow network has a
node per old and per new shard and a depot: old i -> new i costs nothing a
byte, old i -> depot costs one, depot -> new j nothing.  Its cheapest flow
says how many bytes stay in each shard and how many leave or come; leaving
and arriving bytes are matched in shard order into transfers.  The network
has three arcs a shard, so solving it on the driver depends on the number of
shards alone.

Rows are placed without a shuffle of their texts.  In an old shard they stand
in the order (size class, largest first; scan partition; place in it).  Each
task sums sizes by (shard, class) as it passes its rows; a table of these
sums, one row per scan partition, shard and class, gives every row its byte
position in its old shard.  The first bytes stay, the following ranges go to
their targets, so only small rows stand at the borders and the sizes of new
shards differ by about one small row.  Positions in the new shards are
counted in the same way.  ``rewrite`` deals the moved texts out once, by shard (a large shard to several
tasks), and writes them; shards that neither lose nor receive rows are left out.

Defined cases: null texts have size 8; null old shards count as shard 0;
repeated rows are placed one by one; an empty table gives no rows; other
columns are carried by ``rewrite`` under their names.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from casework.llm.common import scratch, small_side
from casework.session import write_table

SHARDS = 24


# -- flow ----------------------------------------------------------------------------

class Flow:
    """Minimum-cost flow by successive shortest paths."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def send(self, source: int, sink: int) -> None:
        while True:
            far, via, queued = {source: 0}, {}, {source}
            queue = deque([source])
            while queue:
                a = queue.popleft()
                queued.discard(a)
                for e in self.out[a]:
                    b, d = self.to[e], far[a] + self.cost[e]
                    if self.room[e] and d < far.get(b, 1 << 60):
                        far[b], via[b] = d, e
                        if b not in queued:
                            queued.add(b)
                            queue.append(b)
            if sink not in via:
                return
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.to[via[at] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount


def transfers(sizes: list[int], capacities: list[int]) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes) that move the fewest bytes; what stays in a
    shard comes first among the shard's own.  The sums must be equal."""
    if sum(sizes) != sum(capacities):
        raise ValueError("capacities don't add up to the bytes there are")
    n, m = len(sizes), len(capacities)
    source, sink, depot = n + m, n + m + 1, n + m + 2
    flow = Flow(n + m + 3)
    stay, leave, come = {}, {}, {}
    for i, s in enumerate(sizes):
        flow.arc(source, i, s, 0)
        if i < m:
            stay[i] = flow.arc(i, n + i, s, 0)
        leave[i] = flow.arc(i, depot, s, 1)
    for j, c in enumerate(capacities):
        come[j] = flow.arc(depot, n + j, c, 0)
        flow.arc(n + j, sink, c, 0)
    flow.send(source, sink)
    sent = lambda e: flow.room[e ^ 1]
    out = [(i, i, sent(e)) for i, e in stay.items() if sent(e)]
    arriving = deque([j, sent(e)] for j, e in come.items() if sent(e))
    for i, e in leave.items():
        left = sent(e)
        while left:
            j, room = arriving[0]
            amount = min(left, room)
            out.append((i, j, amount))
            left -= amount
            arriving[0][1] -= amount
            if amount == room:
                arriving.popleft()
    return out


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


# -- placing rows ---------------------------------------------------------------------

def placed_rows(docs: DataFrame, old_shard, old_shards: int, *, text_col: str = "text") -> DataFrame:
    """A written copy of the rows with __old, __size, __class, __part (scan
    partition), __at (bytes of the same part, shard and class before the row)
    and __nth (such rows before it)."""
    own = docs.columns
    sized = docs.select(*own, F.coalesce(F.pmod(F.lit(0) + old_shard, F.lit(old_shards)), F.lit(0)).cast("int").alias("__old"),
                        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 8).cast("long").alias("__size"))
    sized = sized.withColumn("__class", F.length(F.bin("__size")).cast("int"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        held: dict[int, tuple[int, int]] = {}
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy()
            size, key = column("__size").astype(np.int64), column("__old").astype(np.int64) * 64 + column("__class")
            order = np.argsort(key, kind="stable")
            k, s = key[order], size[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, dtype=np.int64)
            before = np.cumsum(s) - s
            count = np.diff(np.append(first, len(k)))
            at = before - np.repeat(before[first], count)
            nth = np.arange(len(k)) - np.repeat(first, count)
            for f, c in zip(first.tolist(), count.tolist()):
                a, n = held.get(int(k[f]), (0, 0))
                at[f:f + c] += a
                nth[f:f + c] += n
                held[int(k[f])] = (a + int(s[f:f + c].sum()), n + c)
            back_at, back_nth = np.empty_like(at), np.empty_like(nth)
            back_at[order], back_nth[order] = at, nth
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(k), part, dtype=np.int64)),
                                              pa.array(back_at.astype(np.int64)), pa.array(back_nth.astype(np.int64))],
                                             names=[*batch.schema.names, "__part", "__at", "__nth"])

    schema = T.StructType([*sized.schema.fields, *(T.StructField(n, T.LongType()) for n in ("__part", "__at", "__nth"))])
    path = scratch(docs.sparkSession, "placed")
    sized.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def reshard(docs: DataFrame, old_shard, old_shards: int, shards: int = SHARDS, *, text_col: str = "text") -> DataFrame:
    """The rows with __size, __old, __shard and __slot (gapless from 0 in a
    shard), in new shards of near equal bytes, moving as few bytes as can be."""
    rows = placed_rows(docs, old_shard, old_shards, text_col=text_col)
    spark = docs.sparkSession
    keys = ["__old", "__class", "__part"]
    sums = write_table(rows.groupBy(*keys).agg(F.sum("__size").alias("__held")), "shard-sums")
    before = Window.partitionBy("__old").orderBy(F.desc("__class"), "__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = write_table(sums.select(*keys, F.coalesce(F.sum("__held").over(before), F.lit(0)).cast("long").alias("__base")),
                        "shard-bases")
    total = {r["__old"]: int(r["n"]) for r in sums.groupBy("__old").agg(F.sum("__held").alias("n")).collect()}  # one row a shard
    sizes = [total.get(i, 0) for i in range(old_shards)]
    ranges, at = [], {}
    for i, j, amount in transfers(sizes, even(sum(sizes), shards)):
        ranges.append((i, at.get(i, 0), at.get(i, 0) + amount, j))
        at[i] = ranges[-1][2]
    ranges = spark.createDataFrame(ranges, "__old int, __from long, __to long, __shard int")  # at most old + new + depot arcs
    middle = F.col("__base") + F.col("__at") + F.expr("__size div 2")
    moved = (rows.join(small_side(bases), keys).withColumn("__middle", middle)
             .join(F.broadcast(ranges.withColumnRenamed("__old", "__of")),
                   (F.col("__old") == F.col("__of")) & (F.col("__middle") >= F.col("__from")) & (F.col("__middle") < F.col("__to"))))
    cells = [*keys, "__shard"]
    counted = moved.groupBy(*cells).agg(F.count(F.lit(1)).alias("__n"), F.min("__nth").alias("__first"))
    order = Window.partitionBy("__shard").orderBy("__old", F.desc("__class"), "__part").rowsBetween(Window.unboundedPreceding, -1)
    slots = write_table(counted.select(*cells, (F.coalesce(F.sum("__n").over(order), F.lit(0)) - F.col("__first")).cast("long")
                                       .alias("__shift")), "shard-slots")
    return (moved.join(small_side(slots), cells).withColumn("__slot", F.col("__nth") + F.col("__shift"))
            .select(*docs.columns, "__old", "__size", "__shard", "__slot"))


def rewrite(moved: DataFrame, path: str, *, only_affected: bool = True) -> list[int]:
    """Write the rows of ``reshard`` below ``path``, a folder per new shard, and
    give the shards written: with ``only_affected`` those that lose or receive
    rows (the files of the others stay valid where they are)."""
    place = write_table(moved.groupBy("__old", "__shard").agg(F.count(F.lit(1)).alias("n")), "shard-moves")
    pairs = [(r["__old"], r["__shard"]) for r in place.collect()]  # at most one row per transfer
    affected = sorted({s for old, new in pairs if old != new or not only_affected for s in (old, new)} & {new for _, new in pairs})
    (moved.filter(F.col("__shard").isin(affected)).drop("__old", "__size").hint("rebalance", "__shard")
     .write.option("compression", "zstd").partitionBy("__shard").parquet(path))
    return affected


def sharded_table(docs: DataFrame) -> DataFrame:
    """Digest of the rewritten files.  The old shard of a document is taken
    from its source, so old shards are as uneven as the sources are."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    moved = reshard(own, F.crc32(F.coalesce("source", F.lit(""))), SHARDS)
    path = scratch(spark, "shards")
    rewrite(moved.drop("source"), path, only_affected=False)  # nothing is on file by shard before the first run
    back = spark.read.schema("doc_id long, text string, __slot long, __shard int").parquet(path)
    text = F.coalesce("text", F.lit(""))
    return back.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.lit("bytes").alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
