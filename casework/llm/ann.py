"""Nearest neighbours by a block matrix join (operator 9).

Vectors are gathered into blocks, queries into blocks of their own.  Query
blocks are dealt to rows and candidate blocks to columns of a grid; each cell
joins its blocks by an equi-join on the cell, so nothing is broadcast and the
work is the stated queries against all rows.  A tile multiplies the int8
forms of two blocks.  With e the exact norm of what quantisation lost of a
vector, the true distance lies within e(query) + e(candidate) of the tile's;
pairs whose lower bound exceeds the query's k-th least upper bound are
dropped, the rest are computed again in double precision on the original
vectors.  Each task merges its tiles by heaps, the last merge is a window over
k rows per query and task.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows with a null id; vectors meet only those
of their own length; with fewer than k candidates all are returned; ties go
to the smaller id; repeated ids are rows of their own, and a query doesn't
meet rows with its own id; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casework.session import write_table

K = 10
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
QUERY_BLOCKS_PER_ROW = 64  # of the grid: bounds what a task keeps heaps for
_BLOCK = "dim int, part int, number int, ids binary, vectors binary"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
            .filter(finite_of("v") & F.exists("v", lambda x: x != 0)))


def finite_of(name: str) -> Column:
    return F.forall(name, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, v) of each scan partition in blocks of one vector length."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part, held, number = TaskContext.get().partitionId(), {}, 0

        def block(dim, ids, vectors):
            nonlocal number
            number += 1
            return pa.record_batch([
                pa.array([dim], type=pa.int32()), pa.array([part], type=pa.int32()), pa.array([number], type=pa.int32()),
                pa.array([np.array(ids, dtype="<i8").tobytes()], type=pa.binary()),
                pa.array([np.array(vectors, dtype="<f8").tobytes()], type=pa.binary())],
                names=["dim", "part", "number", "ids", "vectors"])

        for batch in batches:
            ids, column = batch.column(0).to_numpy(), batch.column(1)
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            for i in range(len(ids)):
                v = flat[ends[i]:ends[i + 1]]
                own, vectors = held.setdefault(len(v), ([], []))
                own.append(ids[i])
                vectors.append(v)
                if len(own) == size:
                    yield block(len(v), own, vectors)
                    del held[len(v)]
        for dim, (own, vectors) in held.items():
            yield block(dim, own, vectors)

    return rows.mapInArrow(run, _BLOCK)


def quantised(vectors):
    """int8 form, scale, and the exact norm of what each vector lost."""
    import numpy as np
    top = np.abs(vectors).max()
    scale = top / 127 if top else 1.0
    small = np.rint(vectors / scale).astype(np.int8)
    return small, scale, np.sqrt(((vectors - small * scale) ** 2).sum(axis=1))


def product(a, b):
    """Exact product of int8 matrices: single precision holds sums of up to
    1,024 products of 7-bit numbers."""
    import numpy as np
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        out += a[:, at:at + 1024].astype(np.float32) @ b[:, at:at + 1024].astype(np.float32).T
    return out


def tile(q_ids, q, c_ids, c, k: int = K):
    """Per query the k nearest of a candidate block: (query rows, ids, distances)."""
    import numpy as np
    (qs, q_scale, q_lost), (cs, c_scale, c_lost) = quantised(q), quantised(c)
    square = lambda m, s: (m.astype(np.float64) ** 2).sum(axis=1) * s * s
    rough = square(qs, q_scale)[:, None] + square(cs, c_scale)[None] - 2 * q_scale * c_scale * product(qs, cs)
    rough = np.sqrt(np.maximum(rough, 0))
    room = (q_lost[:, None] + c_lost[None]) * (1 + 1e-9) + 1e-6 * (rough + 1e-300) + 1e-9 * (q_scale + c_scale)
    own = q_ids[:, None] == c_ids[None]
    upper = np.where(own, np.inf, rough + room)
    nth = min(k, len(c_ids)) - 1
    reach = np.partition(upper, nth, axis=1)[:, nth]
    rows, cols = np.nonzero((rough - room <= reach[:, None]) & ~own)
    total = np.zeros(len(rows))
    for d in range(q.shape[1]):  # component by component, in double precision
        total += (q[rows, d] - c[cols, d]) ** 2
    return rows, c_ids[cols], np.sqrt(total)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, *, id_col: str = "vec_id", vector_col: str = "embedding",
            columns: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query, exactly.
    ``is_query`` is a condition on a column named ``id``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    candidates = write_table(in_blocks(rows, CANDIDATE_BLOCK), "vector-blocks")
    queries = write_table(in_blocks(rows.filter(is_query).coalesce(max(1, spark.sparkContext.defaultParallelism // 2)), QUERY_BLOCK),
                          "query-blocks")
    grid_columns = columns or max(1, min(candidates.count(), 4 * spark.sparkContext.defaultParallelism))
    grid_rows = max(1, -(-queries.count() // QUERY_BLOCKS_PER_ROW))
    deal = lambda n: F.pmod(F.xxhash64("part", "number"), F.lit(n)).cast("int")
    q = (queries.select("dim", deal(grid_rows).alias("r"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q"))
         .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(grid_columns - 1)))))
    c = (candidates.select("dim", deal(grid_columns).alias("c"), F.col("ids").alias("c_ids"), F.col("vectors").alias("v"))
         .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(grid_rows - 1)))))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        best: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                q_ids, q, c_ids, c = (np.frombuffer(batch.column(j)[i].as_buffer(), dtype=t) for j, t in
                                      ((1, "<i8"), (2, "<f8"), (3, "<i8"), (4, "<f8")))
                at, ids, far = tile(q_ids, q.reshape(-1, dim), c_ids, c.reshape(-1, dim), k)
                for a, d, j in sorted(zip(q_ids[at].tolist(), far.tolist(), ids.tolist())):
                    heap = best.setdefault(a, [])
                    if len(heap) < k:
                        heapq.heappush(heap, (-d, -j))
                    elif (-d, -j) > heap[0]:
                        heapq.heapreplace(heap, (-d, -j))
        rows = [(a, -j, -d) for a, heap in best.items() for d, j in heap]
        for at in range(0, len(rows), 50_000):
            x, y, z = zip(*rows[at:at + 50_000])
            yield pa.record_batch([pa.array(x, type=pa.int64()), pa.array(y, type=pa.int64()), pa.array(z, type=pa.float64())],
                                  names=["query_id", "vec_id", "score"])

    tiles = q.join(c, ["dim", "r", "c"]).select("dim", "q_ids", "q", "c_ids", "v")
    found = tiles.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest_table(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("id") % 100 == 0)


NEAREST_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
             AND len([x for x in embedding if x <> 0]) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""
