"""Line dedup by overlapping three-line windows (operator 6).

Every three consecutive lines of a document are hashed (two 64-bit hashes).
A window that occurs more than once in the table keeps its first occurrence,
by (doc_id, position); each later occurrence covers its three lines, and the
union of covered lines leaves the document.  The first occurrence of a line
text is never covered by a later window alone, so no line text is lost.

DataFrame operations only.  Hot windows meet in an aggregation with map-side
combine, and in a join whose other side has one row a window, which adaptive
execution may split.

Defined cases: windows of three blank lines don't count; documents of fewer
than three lines stay as they are; a null text stays null (0 lines), a null
doc_id sorts first; rows alike in doc_id and text are treated alike; an empty
table gives no rows; other columns pass through ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.session import write_table

WINDOW = 3


def _windows(lines: Column) -> Column:
    """Array of (pos, h1, h2), one for each three consecutive lines."""
    def at(i: Column) -> Column:
        three = [F.get(lines, i + k) for k in range(WINDOW)]
        return F.struct(i.alias("pos"), F.xxhash64(*three).alias("h1"), F.xxhash64(F.lit("two"), *reversed(three)).alias("h2"),
                        (F.trim(F.concat(*three)) == "").alias("blank"))

    many = F.transform(F.sequence(F.lit(0), F.size(lines) - WINDOW), at)
    return F.when(F.size(lines) >= WINDOW, F.filter(many, lambda w: ~w["blank"]))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The table with the text of each document without its repeated windows,
    and __n_lines and __n_removed."""
    lines = F.split("text", "\n")
    # the lines are a column of their own, else each window would split the text again
    found = write_table(
        docs.select("doc_id", F.xxhash64("text").alias("key"), lines.alias("lines"))
        .select("doc_id", "key", F.explode(_windows(F.col("lines"))).alias("w"))
        .select("doc_id", "key", "w.pos", "w.h1", "w.h2"), "line-windows")
    at = F.struct("doc_id", "key", "pos")
    repeated = (found.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("h1", "h2", "first"))
    later = found.join(repeated, ["h1", "h2"]).filter(~at.eqNullSafe(F.col("first")))
    covered = later.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("__starts"))
    covered = covered.withColumnsRenamed({"doc_id": "__id", "key": "__key"})
    cut = docs.join(covered, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left")
    cut = cut.withColumn("__lines", lines)
    gone = F.array_distinct(F.flatten(F.transform("__starts", lambda p: F.array(*[p + k for k in range(WINDOW)]))))
    n = F.coalesce(F.size("__lines"), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    text = F.when(F.col("__starts").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.col("__kept"), lambda i: F.get(F.col("__lines"), i)), "\n"))
    out = (cut.withColumn("__gone", gone).withColumn("__kept", F.when(F.col("__gone").isNotNull(), kept))
           .withColumn("__n_lines", F.when(F.col("text").isNull(), 0).otherwise(n).cast("long"))
           .withColumn("__n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long")))
    out = out.withColumn("__n_removed", F.when(F.col("__starts").isNull(), F.lit(0)).otherwise(F.col("__n_removed")).cast("long"))
    return out.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns], "__n_lines", "__n_removed")


def line_table(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


LINES_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p, l[p + 1] AS a, l[p + 2] AS b, l[p + 3] AS c
      FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS p FROM d)),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS nth
      FROM w WHERE trim(a || b || c, ' ') <> ''),
g AS (SELECT DISTINCT doc_id, p + k AS i FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
e AS (SELECT d.doc_id, u.i, u.line FROM d, (SELECT doc_id, unnest(range(0, len(l))) AS i, unnest(l) AS line FROM d) u
      WHERE d.doc_id = u.doc_id),
k AS (SELECT e.doc_id, count(g.i) AS n_removed, count(*) AS n_lines,
             coalesce(string_agg(e.line, chr(10) ORDER BY e.i) FILTER (g.i IS NULL), '') AS kept
      FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, k.kept AS text
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
