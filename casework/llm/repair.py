"""Conversation structure repair by an auction shortest-path algorithm (operator 13).

A conversation's rows and the states of the grammar of roles span a lattice;
its arcs are the edits Delete, Insert, Keep and Rerole at their integer costs.
Every node has a price.  A path starts at a node: if the price at its end is
below the cheapest arc plus the price beyond, it rises to that and the path
contracts; else the path is extended along that arc.  Nodes are origins from
the last row back, so a path soon meets one whose price is final.  Prices then
are distances to the end, an arc is tight if its cost is their difference, and
the first tight arc by ASCII, again and again, is the least of all cheapest
audits: a state has one arc of each initial at most.

Long conversations are cut into blocks of ``BLOCK`` rows.  Each block's
distances between states make a small matrix; a conversation's matrices (one
row a block) are combined from its end, then every block is traced by itself
from each state, and the pieces are put together.

Defined cases: nulls are one space each, also in the key of the damage; rows
of equal turn are ordered by role, then text, as they were before the damage;
a null conv_id is a conversation of its own; a role that begins with none of
s, u and a can't be kept as it is, and its initial is illegal beside any; an
empty table gives no rows; other columns are ignored.  The digest of a
conversation is taken by one task, as it must be, as a stream in order.
"""

from __future__ import annotations

from itertools import chain, groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import shuffle_partitions
from casework.llm.ordering import in_order, running, with_next
from casework.session import write_table

BLOCK = 512
INSERT, DELETE, REROLE, CUT_OFF = 5, 2, 1, 5  # costs; CUT_OFF: an undeleted truncated row
BLANKS = " \t\n\x0b\x0c\r"
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing
FAR = 1 << 60

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
NEXT_ROLE = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: States from which each state can be reached.
BEHIND = {0: (0,), 1: (0, 1), 2: (0, 1, 2, 3), 3: (0, 1, 2, 3)}


# -- lattice ----------------------------------------------------------------------------

def arcs(code: str, state: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows passed, state) by ASCII.  code: the row's role
    initial, upper case if it is truncated; - must be deleted."""
    out = [("D", DELETE, 1, state)]
    role, after = NEXT_ROLE[state]
    out.append(("I", INSERT, 0, after))
    if code != "-":
        more = CUT_OFF * code.isupper()
        if (state, code.lower()) in KEEPS:
            out.append(("K", more, 1, KEEPS[state, code.lower()]))
        if code.lower() != role[0]:
            out.append(("R", REROLE + more, 1, after))
    return out


ARCS = {(code, state): arcs(code, state) for code in "-suaxSUAX" for state in range(4)}


def prices(codes: str, end: tuple[int, ...], states: tuple[int, ...] = (0, 1, 2, 3)) -> list[list[int]]:
    """Distance to the end from every (row, state).  end: price of each state
    past the last row.  Only ``states`` take part."""
    n = len(codes)
    price = [[0] * 4 for _ in range(n)] + [list(end)]
    final = [[False] * 4 for _ in range(n)] + [[True] * 4]
    for row in range(n - 1, -1, -1):
        for origin in states:
            path = [(row, origin)]
            while not final[path[-1][0]][path[-1][1]]:
                at, state = path[-1]
                best, to = FAR, None
                for _, cost, passed, after in ARCS[codes[at], state]:
                    if after in states and cost + price[at + passed][after] < best:
                        best, to = cost + price[at + passed][after], (at + passed, after)
                if price[at][state] < best:
                    price[at][state] = best
                    if len(path) > 1:
                        path.pop()
                elif to is None:  # no way to the end
                    break
                else:
                    path.append(to)
            for at, state in path:
                final[at][state] = True
    return price


def trace(codes: str, price: list[list[int]], state: int) -> tuple[str, int]:
    """The least cheapest audit from a state, and the state past the last row."""
    row, audit = 0, []
    while row < len(codes):
        for label, cost, passed, after in ARCS[codes[row], state]:
            if cost + price[row + passed][after] == price[row][state]:
                break
        audit.append(label)
        row, state = row + passed, after
    return "".join(audit), state


#: Past the last row of a conversation: what each state inserts to be allowed to end, and its cost.
CLOSING = ("", "II", "I", "")
CLOSE = tuple(INSERT * len(c) for c in CLOSING)


def matrix(codes: str) -> list[int]:
    """Distances from state to state through a block, FAR if there is no way."""
    out = [FAR] * 16
    for goal in range(4):
        price = prices(codes, tuple(0 if q == goal else FAR for q in range(4)), BEHIND[goal])
        for q in BEHIND[goal]:
            out[4 * q + goal] = min(price[0][q], FAR)
    return out


# -- rows -------------------------------------------------------------------------------

def _damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, and the row's place: role0, text0, copy)."""
    space = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", space).alias("role0"),
                                F.coalesce("text", space).alias("text0"))
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20).filter("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text0", "[.!?]", ""))
            .otherwise(F.col("text0")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", "role0", "text0", F.explode(copies).alias("copy"),
                       F.when(F.col("kind") == 4, "user").otherwise(F.col("role0")).alias("role"), text.alias("text"))


def _place() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role0"), F.col("text0"), F.col("copy")]


def _with(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on conv; null matches null."""
    right = right.withColumnRenamed("conv", "conv_right")
    return left.join(right, F.col("conv").eqNullSafe(F.col("conv_right")), how).drop("conv_right")


def audited_rows(damaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, d, code) of every row in order, and the counts of each conversation."""
    bare = F.rtrim("text", F.lit(BLANKS))
    narrow = damaged.withColumns({
        "initial": F.substring("role", 1, 1), "g1": F.xxhash64("role", "text"), "g2": F.xxhash64(F.lit(2), "text", "role"),
        "blank": F.ltrim(bare, F.lit(BLANKS)) == "", "cut": ~F.substring(bare, -1, 1).isin(".", "!", "?")})
    placed = in_order(narrow, _place(), "rows-in-order", ["conv", "turn", "initial", "g1", "g2", "blank", "cut"])
    placed = write_table(running(placed, {"d": F.lit(1).cast("long")}, key="conv"), "rows-numbered")
    first = placed.groupBy("conv", "g1", "g2").agg(F.min("d").alias("first")).filter("first is not null")
    first = first.withColumnsRenamed({"conv": "c", "g1": "x1", "g2": "x2"})
    rows = placed.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("g1") == F.col("x1")) & (F.col("g2") == F.col("x2")))
    fault = (F.when(F.col("blank"), "blank").when(F.col("d") > F.col("first"), "duplicate")
             .when(F.col("cut"), "truncated").otherwise("none"))
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(initial))
            .otherwise(initial))
    rows = write_table(rows.withColumn("fault", fault).select("conv", "d", "fault", code.alias("code")), "rows-coded")
    faults = rows.groupBy("conv").agg(*[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])

    beside = with_next(placed, ["conv", "turn", "initial", "d"])
    goes_on = F.col("next_d").isNotNull() & F.col("conv").eqNullSafe(F.col("next_conv"))
    illegal = goes_on & ~F.concat("initial", "next_initial").isin("su", "ua", "au")
    new_turn = F.col("turn").isNotNull() & ~(goes_on & F.col("turn").eqNullSafe(F.col("next_turn")))
    span = F.max("turn") - F.min("turn") + 1 - F.count_if(new_turn)
    shape = beside.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), F.count_if(illegal).alias("illegal"))
    return rows.select("conv", "d", "code"), _with(faults, shape)


def audits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (conv, d from 1, code) -> pieces of the audit (conv, block, audit)
    and costs (conv, cost)."""
    blocks = rows.groupBy("conv", F.floor((F.col("d") - 1) / BLOCK).cast("long").alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("d", "code"))), lambda r: r["code"]), "").alias("codes"))
    blocks = write_table(blocks, "blocks")
    ends = blocks.groupBy("conv").agg(F.max("block").alias("last"))
    blocks = _with(blocks, ends, "inner")
    whole, part = blocks.filter("last = 0").select("conv", "block", "codes"), blocks.filter("last > 0").select("conv", "block", "codes")

    def solve(batches):
        import functools
        import pyarrow as pa

        @functools.lru_cache(maxsize=4096)
        def short(codes):
            price = prices(codes, CLOSE)
            audit, state = trace(codes, price, 0)
            return audit + CLOSING[state], price[0][0]

        for batch in batches:
            out = [short(c) if len(c) <= 64 else short.__wrapped__(c) for c in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([a for a, _ in out], type=pa.string()),
                                   pa.array([c for _, c in out], type=pa.int64())], names=["conv", "block", "audit", "cost"])

    solved = write_table(whole.mapInArrow(solve, "conv long, block long, audit string, cost long"), "audits")

    def measure(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([matrix(c) for c in batch.column(2).to_pylist()],
                                                                              type=pa.list_(pa.int64()))], names=["conv", "block", "m"])

    def from_the_end(frame):
        import pandas as pd
        frame = frame.sort_values("block", ascending=False)
        price, beyond = list(CLOSE), []
        for m in frame["m"]:
            beyond.append(price)
            price = [min(m[4 * q + p] + price[p] for p in range(4)) for q in range(4)]
        return pd.DataFrame({"conv": frame["conv"], "block": frame["block"], "beyond": beyond, "cost": price[0]})

    long = "conv long, block long, beyond array<long>, cost long"
    measured = part.mapInArrow(measure, "conv long, block long, m array<long>")
    beyond = write_table(measured.groupBy("conv").applyInPandas(from_the_end, long), "block-prices")

    def trace_each(batches):
        import pyarrow as pa
        for batch in batches:
            pieces, ends = [], []
            for codes, end in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                price = prices(codes, tuple(end))
                found = [trace(codes, price, q) for q in range(4)]
                pieces.append([a for a, _ in found])
                ends.append([q for _, q in found])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(pieces, type=pa.list_(pa.string())),
                                   pa.array(ends, type=pa.list_(pa.int64()))], names=["conv", "block", "pieces", "ends"])

    both = part.join(beyond.select(F.col("conv").alias("c"), F.col("block").alias("b"), "beyond"),
                     F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select("conv", "block", "codes", "beyond")
    traced = write_table(both.mapInArrow(trace_each, "conv long, block long, pieces array<string>, ends array<long>"), "block-audits")

    def from_the_start(frame):
        import pandas as pd
        frame = frame.sort_values("block")
        state, states = 0, []
        for ends in frame["ends"]:
            states.append(state)
            state = int(ends[state])
        tails = [""] * (len(frame) - 1) + [CLOSING[state]]
        return pd.DataFrame({"c": frame["conv"], "b": frame["block"], "state": states, "tail": tails})

    chosen = traced.select("conv", "block", "ends").groupBy("conv").applyInPandas(from_the_start, "c long, b long, state long, tail string")
    pieces = traced.join(chosen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv", "block", F.concat(F.element_at("pieces", (F.col("state") + 1).cast("int")), "tail").alias("audit"))
    return (solved.select("conv", "block", "audit").union(pieces),
            solved.select("conv", "cost").union(beyond.filter("block = 0").select("conv", "cost")))


def edited(rows, audit: str):
    """(role, text) of the repaired conversation.  rows: (role, text) in order."""
    state, at = 0, 0
    for row in chain(rows, [None]):
        while audit[at:at + 1] == "I":
            role, state = NEXT_ROLE[state]
            yield role, ""
            at += 1
        if row and audit[at] == "K":
            state = KEEPS[state, row[0][:1]]
            yield row
        elif row and audit[at] == "R":
            role, state = NEXT_ROLE[state]
            yield role, row[1]
        at += 1


def repaired(damaged: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256)."""
    none = F.lit(None).cast("string")
    turn = damaged.schema["turn"].dataType
    told = pieces.select("conv", F.lit(0).alias("kind"), "block", F.lit(None).cast(turn).alias("turn"), none.alias("role0"), none.alias("text0"),
                         F.lit(0).alias("copy"), F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = damaged.select("conv", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), "turn", "role0", "text0", "copy", "role", "text")
    place = [F.col("conv").asc_nulls_first(), F.col("kind"), F.col("block"), *_place()[1:]]

    def run(batches):
        import hashlib
        import pyarrow as pa

        def conversations():
            ordered = chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)
            for conv, group in groupby(ordered, key=itemgetter(0)):
                pieces, first = [], None
                for row in group:
                    if row[1]:
                        first = row
                        break
                    pieces.append(row[3])
                audit, digest, lead = "".join(pieces), hashlib.sha256(), ""
                own = ((row[2], row[3]) for row in chain([first] if first else [], group))
                for role, text in edited(own, audit):
                    digest.update(f"{lead}{role}:{text}".encode())
                    lead = "\n"
                yield conv, audit, digest.hexdigest()

        def table(rows):
            return pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))],
                                   names=["conv", "audit", "repaired_sha256"])

        rows, size = [], 0
        for row in conversations():
            rows.append(row)
            size += len(row[1]) + 100
            if size > 4_000_000:
                yield table(rows)
                rows, size = [], 0
        if rows:
            yield table(rows)

    dealt = told.union(rows).repartition(shuffle_partitions(damaged.sparkSession), "conv").sortWithinPartitions(*place)
    return dealt.select("conv", "kind", "role", "text").mapInArrow(run, "conv long, audit string, repaired_sha256 string")


def repair_table(conversations: DataFrame) -> DataFrame:
    damaged = _damaged(conversations)
    rows, counts = audited_rows(damaged)
    pieces, costs = audits(rows)
    result = _with(_with(_with(conversations.select(F.col("conv_id").cast("long").alias("conv")).distinct(), counts), costs),
                   repaired(damaged, pieces))
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return result.select(F.col("conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))
