"""Prefix trie of conversations by an Euler tour (operator 12).

Conversations that begin with the same turns share the nodes of a trie.  Every
node has an arc into it and one out of it; together the arcs are one list, the
tour.  The list is ranked by contraction: tasks splice out all arcs whose
predecessor they hold too, and what is left is dealt out anew, by ranges of
arc numbers while that halves the list, else by the toss of a coin for each
arc, which moves it to its successor or keeps it at home, and splices out a
quarter of any list.  At ``FEW`` arcs one task ends it, and the ranks are
handed back round by round.  What holds for a subtree is then a difference of
running totals at its two arcs.

A turn sequence is known by its length and two 64-bit hashes, each the
exclusive or of a hash of every (place, role, text).

Defined cases: a null role or text is empty; turns are ordered by turn (null
first), then role and text; rows with a null conv_id belong to no
conversation; repeated rows are turns of their own; a table without
conversations has no nodes; other columns are ignored.  The ids that end at
one node are digested by one task, as that digest must be, in sorted order as
a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import shuffle_partitions
from casework.llm.ordering import in_order, numbered, running, with_next
from casework.session import write_table

SHARE, LONGEST = 20, 4  # a block of conversations shares the first 0 to 3 turns of its first
FEW = 4096
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing


# -- turns -----------------------------------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, d, h1, h2, words): the turns in order, d from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
            .filter("conv is not null"))
    rows = rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(2), "text", "role"),
                             "words": F.regexp_count("text", F.lit(WORD)).cast("long")})
    placed = in_order(rows, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "turns-in-order",
                      ["conv", "h1", "h2", "words"])
    own = running(placed, {"d": F.lit(1).cast("long")}, key="conv")
    return write_table(own.drop("part", "at"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and all conv ids: a conversation
    takes its first turns, as many as a hash of its id says, from the first
    conversation of its block."""
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(LONGEST))
    convs = write_table(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
                        .withColumn("h", head).withColumn("base", F.col("conv") - F.col("conv") % SHARE), "convs")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = write_table(convs.join(bases, "base", "left")
                        .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "convs-based")
    begins = turns.filter(F.col("d") < LONGEST).withColumnRenamed("conv", "base")
    begun = begins.join(convs.filter("taken > 0").select("conv", "base", "taken"), "base").filter("d <= taken")
    own = turns.filter(F.col("d") > head).join(convs.select("conv", "h", "taken"), "conv")
    own = own.withColumn("d", F.col("d") - F.col("h") + F.col("taken"))
    columns = ["conv", "d", "h1", "h2", "words"]
    return begun.select(*columns).union(own.select(*columns)), convs.select("conv")


# -- list ranking ----------------------------------------------------------------------

def splice(ids, succ, size):
    """Arcs whose predecessor is there too go into its segment: (head, offset)
    of each, and (successor, size) of the segment it heads, if it does.
    ids: sorted; succ: -1 at the end of the list."""
    import numpy as np
    n = len(ids)
    place = np.searchsorted(ids, succ)
    place[place == n] = 0
    here = (succ >= 0) & (ids[place] == succ)
    pred = np.full(n, -1)
    pred[place[here]] = np.flatnonzero(here)
    jump, offset = np.where(pred >= 0, pred, np.arange(n)), np.where(pred >= 0, size[pred], 0)
    while True:  # pointer jumping: offset is the size of what lies from jump to here
        far = jump[jump]
        if (far == jump).all():
            break
        offset, jump = offset + offset[jump], far
    last = np.flatnonzero(~here)  # each ends one segment
    out_succ, out_size = np.full(n, -1), np.zeros(n, dtype=np.int64)
    out_succ[jump[last]] = succ[last]
    out_size[jump[last]] = offset[last] + size[last]
    return ids[jump], offset, out_succ, out_size


def _spliced(dealt: DataFrame) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = [b for b in batches if b.num_rows]
        if held:
            ids, succ, size = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3))
            order = np.argsort(ids)
            ids, succ, size = ids[order], succ[order], size[order]
            yield pa.record_batch([pa.array(c) for c in (ids, *splice(ids, succ, size))], names=["id", "head", "offset", "succ", "size"])

    return write_table(dealt.mapInArrow(run, "id long, head long, offset long, succ long, size long"), "spliced")


def ranks(arcs: DataFrame) -> DataFrame:
    """arcs (id, succ: the next arc's id, -1 at the end; ids from 0) of one
    list -> (id, rank)."""
    spark = arcs.sparkSession
    left, rounds, mate = arcs.select("id", "succ", F.lit(1).cast("long").alias("size")), [], False
    n = left.count()
    while True:
        parts = min(shuffle_partitions(spark), n // FEW + 1)
        if n <= FEW:
            dealt = left.repartition(1)
        elif mate:
            moves = (F.xxhash64(F.lit(len(rounds)), "id") % 2 == 0) & (F.col("succ") >= 0)
            dealt = left.repartition(parts, F.when(moves, F.col("succ")).otherwise(F.col("id")))
        else:
            dealt = left.repartitionByRange(parts, "id")
        rounds.append(_spliced(dealt))
        if n <= FEW:
            break
        left = rounds[-1].filter("id = head").select("id", "succ", "size")
        then, n = n, left.count()
        mate = 2 * n > then
    known = rounds.pop().select("id", F.col("offset").alias("rank"))
    while rounds:
        heads = known.select(F.col("id").alias("head"), "rank")
        known = write_table(rounds.pop().join(heads, "head").select("id", (F.col("rank") + F.col("offset")).alias("rank")), "ranks")
    return known


# -- the trie --------------------------------------------------------------------------

def _ends(ending: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, in ascending order."""
    def run(batches):
        import hashlib
        import pyarrow as pa
        now, digest = None, None

        def row(key, digest):
            return pa.record_batch([pa.array([v], type=t) for v, t in zip((*key, digest.hexdigest()), (pa.int64(),) * 3 + (pa.string(),))],
                                   names=["d", "k1", "k2", "ends_sha256"])

        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now:
                        yield row(now, digest)
                    now, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
        if now:
            yield row(now, digest)

    keys = ["d", "k1", "k2"]
    return (ending.select(*keys, "conv").repartition(shuffle_partitions(ending.sparkSession), *keys)
            .sortWithinPartitions(*keys, "conv").mapInArrow(run, "d long, k1 long, k2 long, ends_sha256 string"))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """turns (conv, d from 1 without gaps, h1, h2, words), convs (conv: all of
    them, also turnless ones) -> one row a node."""
    placed = in_order(turns, [F.col("conv"), F.col("d")], "rebuilt")
    own = {"k1": F.xxhash64("d", "h1", "h2"), "k2": F.xxhash64("h2", "d", "h1")}
    keyed = running(placed, own, F.bit_xor, key="conv")
    keyed = write_table(keyed.select("conv", "d", "k1", "k2", "words", F.col("k1").bitwiseXOR(own["k1"]).alias("q1"),
                                     F.col("k2").bitwiseXOR(own["k2"]).alias("q2")), "prefixes")
    zero = F.lit(0).cast("long")
    nodes = keyed.groupBy("d", "k1", "k2").agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                               *[F.min(c).alias(c) for c in ("words", "q1", "q2")])
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    nodes = nodes.unionByName(root.select(*[zero.alias(c) for c in ("d", "k1", "k2")], "conv_id", "n_convs", zero.alias("words"),
                                          *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2")]))
    # numbered along paths: a conversation is the smallest member of one downward path
    nodes = write_table(numbered(in_order(nodes, [F.col("conv_id"), F.col("d")], "nodes"), "node").drop("part", "at"), "nodes-numbered")

    above = nodes.select((F.col("d") + 1).alias("d"), F.col("k1").alias("q1"), F.col("k2").alias("q2"),
                         F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = write_table(nodes.filter("d > 0").select("node", "d", "q1", "q2").join(above, ["d", "q1", "q2"])
                           .select("node", "parent", "parent_conv_id"), "children")
    next_of = with_next(in_order(children.select("parent", "node"), [F.col("parent"), F.col("node")], "siblings"), ["parent", "node"])
    family = children.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.min("node").alias("first"))
    nodes = write_table(nodes.join(children, "node", "left").join(family.withColumnRenamed("parent", "node"), "node", "left")
                        .withColumn("n_children", F.coalesce("n_children", zero)), "family")

    into = nodes.select((2 * F.col("node")).alias("id"),
                        F.when(F.col("first").isNull(), 2 * F.col("node") + 1).otherwise(2 * F.col("first")).alias("succ"))
    out = next_of.select((2 * F.col("node") + 1).alias("id"),
                         F.when(F.col("next_parent") == F.col("parent"), 2 * F.col("next_node"))
                         .otherwise(2 * F.col("parent") + 1).alias("succ"))
    end = nodes.filter("d = 0").select((2 * F.col("node") + 1).alias("id"), F.lit(-1).cast("long").alias("succ"))
    tour = ranks(write_table(into.union(out).union(end), "arcs"))

    saved = F.when(F.col("d") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    weights = nodes.select((2 * F.col("node")).alias("id"), (F.col("n_children") == 0).cast("long").alias("leaf"), saved.alias("saved"))
    weighed = tour.join(weights, "id", "left").select("id", "rank", *[F.coalesce(c, zero).alias(c) for c in ("leaf", "saved")])
    placed = in_order(weighed, [F.col("rank")], "tour")
    enters = F.col("id") % 2 == 0
    sums = running(placed, {"leaves": F.col("leaf"), "tokens": F.col("saved")})

    def inside(total: str, own: str):
        """The total at the arc out, less the total before the arc in."""
        return F.sum(F.when(enters, F.col(own) - F.col(total)).otherwise(F.col(total))).cast("long")

    subtree = sums.groupBy(F.expr("id div 2").alias("node")).agg(inside("leaves", "leaf").alias("n_leaves"),
                                                               inside("tokens", "saved").alias("saved_tokens"))
    last = keyed.groupBy("conv").agg(F.max("d").alias("d")).join(keyed.select("conv", "d", "k1", "k2"), ["conv", "d"])
    turnless = convs.join(last.select("conv"), "conv", "left_anti").select(*[zero.alias(c) for c in ("d", "k1", "k2")], "conv")
    ends = _ends(last.select("d", "k1", "k2", "conv").union(turnless))
    return (nodes.join(subtree, "node").join(ends, ["d", "k1", "k2"], "left")
            .select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))


def trie_table(conversations: DataFrame) -> DataFrame:
    turns, convs = rebuilt(turns_of(conversations))
    return trie(turns, convs)


# DuckDB has no crc32: the CRC of the id's digits, bit by bit.
TRIE_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
             xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                             lambda a, b: list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384)
                                                                             ELSE r >> 1 END, xor(a, b)),
                             4294967295::BIGINT), 4294967295::BIGINT) % 4 AS h,
             list({'r': role, 't': text} ORDER BY d) AS own
      FROM t GROUP BY conv_id),
b AS (SELECT c.conv_id, list_concat(coalesce(p.own[1:c.h], []), c.own[c.h + 1:]) AS seq FROM c LEFT JOIN c p ON p.conv_id = c.base),
m AS (SELECT conv_id, d, seq[1:d] AS k FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM b)),
n AS (SELECT d, k, min(conv_id) AS node, count(*) AS n_convs FROM m GROUP BY d, k),
o AS (SELECT m.conv_id, m.d, n.node, n.n_convs FROM m JOIN n ON m.d = n.d AND m.k = n.k),
p AS (SELECT n.node, n.d, n.n_convs, o.node AS parent,
             CASE WHEN n.d > 0 THEN (n.n_convs - 1) * len(regexp_extract_all(n.k[-1].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
      FROM n LEFT JOIN o ON o.conv_id = n.node AND o.d = n.d - 1),
f AS (SELECT p.*, (SELECT count(*) FROM p q WHERE q.parent = p.node AND q.d = p.d + 1) AS n_children FROM p),
s AS (SELECT o.node, o.d, sum((f.n_children = 0)::BIGINT) AS n_leaves, sum(f.saved) AS saved_tokens
      FROM f JOIN o ON o.conv_id = f.node AND o.d <= f.d GROUP BY o.node, o.d),
e AS (SELECT o.node, o.d, string_agg(o.conv_id::VARCHAR, ',' ORDER BY o.conv_id) AS ids
      FROM o JOIN b ON o.conv_id = b.conv_id AND o.d = len(b.seq) GROUP BY o.node, o.d)
SELECT f.node AS conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n_convs, f.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM f JOIN s ON f.node = s.node AND f.d = s.d LEFT JOIN e ON f.node = e.node AND f.d = e.d
"""
