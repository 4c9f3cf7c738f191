"""CSV records with line breaks in quoted fields, read by many tasks.

Whether a line begins inside a quoted field depends on everything before it in
its file.  A first pass over the lines of each split finds the state at its
end for either state at its start, one row a split; windows over a file's
splits turn these into the state at each start.  A second pass puts lines
together to records.  A record that runs over a border leaves as pieces, at
most two a split, which are joined by file and place.  ``from_csv`` parses
each record once.

Fields follow RFC 4180: a field is quoted if its first sign is a quote, a
quote inside it is doubled, and signs after its closing quote belong to it up
to the next separator.  Lines end in a line feed, or in carriage return and
line feed.  A quote that never closes makes the rest of its file one record,
as it does for Spark's CSV reader.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from casework.operators.joins import materialize_checked

_SPLIT = ["file", "block"]
_WHOLE, _HEAD, _THROUGH, _TAIL = 0, 1, 2, 3  # pieces of a record stand in this order in a split


def open_after(line: str, sep: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one is at its start."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        inside, at = False, line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch):
    """(file, block, from, to) of the rows of a batch that lie in one split."""
    import numpy as np
    if not batch.num_rows:
        return
    files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    of = files.indices.to_numpy()
    edges = np.flatnonzero((of[1:] != of[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        yield files.dictionary[int(of[low])].as_py(), int(blocks[low]), low, high


def scan_splits(spark: SparkSession, paths: list[str], sep: str, multiline: bool = True) -> DataFrame:
    """A row a split: file, block, whether a quoted field is open at its end if
    none (``after_out``) or one (``after_in``) is at its start; for the first
    split of a file its banner line and the header record, null if that doesn't
    end in the split."""
    def run(batches):
        import pyarrow as pa
        at, out, inn, top, part = None, False, True, [], []

        def row():
            banner, header = (top + [None, None])[:2]
            if header is None and not part:  # a file of one line
                header = banner
            return pa.record_batch([pa.array([at[0]]), pa.array([at[1]], type=pa.int64()), pa.array([out]), pa.array([inn]),
                                    pa.array([banner], type=pa.string()), pa.array([header], type=pa.string())],
                                   names=["file", "block", "after_out", "after_in", "banner", "header"])

        for batch in batches:
            for file, block, low, high in _runs(batch):
                if at != (file, block):
                    if at:
                        yield row()
                    at, out, inn, top, part = (file, block), False, True, [], []
                for line in batch.column(2).slice(low, high - low).drop_null().to_pylist():
                    if block == 0 and not top:
                        top.append(line.removeprefix("\ufeff").removesuffix("\r"))
                        continue
                    if multiline:
                        out, inn = open_after(line, sep, out), open_after(line, sep, inn)
                    if block == 0 and len(top) < 2:
                        part.append(line)
                        if not out:
                            top.append("\n".join(part).removesuffix("\r"))
        if at:
            yield row()

    lines = _lines(spark, paths)  # lines without quotes change no state, so their text stays in the JVM
    value = F.when((F.col("block") == 0) | F.col("value").contains('"'), F.col("value")).alias("value")
    return lines.select(*_SPLIT, value).mapInArrow(
        run, "file string, block long, after_out boolean, after_in boolean, banner string, header string")


def border_splits(splits: DataFrame) -> DataFrame:
    """The splits (file, block) that begin (``begins``) or end (``ends``) inside
    a quoted field.  A split whose end doesn't depend on its start settles the
    state; those after it keep it or turn it."""
    order = Window.partitionBy("file").orderBy("block")
    settled, turned = F.col("after_out") == F.col("after_in"), F.col("after_out") & ~F.col("after_in")
    marked = splits.withColumn("turns", F.sum(turned.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = lambda c: F.last(F.when(settled, c), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    odd = (F.col("turns") - F.coalesce(last(F.col("turns")), F.lit(0))) % 2 == 1
    marked = marked.withColumn("ends", F.coalesce(last(F.col("after_out")), F.lit(False)) != odd)
    return (marked.withColumn("begins", F.coalesce(F.lag("ends").over(order), F.lit(False)))
                  .filter("begins OR ends").select(*_SPLIT, "begins", "ends"))


def records(spark: SparkSession, paths: list[str], borders: DataFrame, small: bool, some: bool, sep: str,
            multiline: bool = True) -> DataFrame:
    """Column ``record``: the records of the files without banner and header.
    ``borders`` are their splits from ``border_splits``; ``small`` says whether
    they may be broadcast, ``some`` whether there are any."""
    def run(batches):
        import pyarrow as pa
        at, inside, own, held, skip, out = None, False, True, [], 0, []

        def settle(kind):
            nonlocal held, own, skip
            if skip and kind in (_WHOLE, _TAIL):
                skip -= 1
            else:
                out.append((*at, kind, "\n".join(held)))
            held, own = [], True

        def flush():
            nonlocal out
            file, block, kind, record = zip(*out)
            out = []
            return pa.record_batch([pa.array(file), pa.array(block, type=pa.int64()), pa.array(kind, type=pa.int32()),
                                    pa.array(record, type=pa.string())], names=["file", "block", "kind", "record"])

        for batch in batches:
            for file, block, low, high in _runs(batch):
                if at != (file, block):
                    if held:
                        settle(_TAIL if own else _THROUGH)
                    at, inside = (file, block), bool(batch.column(3)[low].as_py())
                    own, skip, banner = not inside, int(block == 0), block == 0
                for line in batch.column(2).slice(low, high - low).to_pylist():
                    if banner:
                        banner = False
                        continue
                    held.append(line)
                    inside = multiline and open_after(line, sep, inside)
                    if not inside:
                        settle(_WHOLE if own else _HEAD)
                if len(out) >= 5000:
                    yield flush()
        if held:
            settle(_TAIL if own else _THROUGH)
        if out:
            yield flush()

    shape = "file string, block long, kind int, record string"
    lines = _lines(spark, paths)

    def begun(how: str) -> DataFrame:
        if not some:
            return lines.withColumn("begins", F.lit(False))
        if small:  # the lines stay in their order
            return lines.join(F.broadcast(borders.select(*_SPLIT, "begins")), _SPLIT, how).select(*_SPLIT, "value", "begins")
        numbered = lines.withColumn("id", F.monotonically_increasing_id())
        return (numbered.join(borders, _SPLIT, how).repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "id")
                        .select(*_SPLIT, "value", "begins"))

    whole = begun("left").mapInArrow(run, shape).filter(F.col("kind") == _WHOLE).select("record")
    if some:
        place = Window.partitionBy("file").orderBy("block", "kind")
        pieces = begun("inner").mapInArrow(run, shape).filter(F.col("kind") != _WHOLE)
        pieces = pieces.withColumn("nth", F.sum((F.col("kind") == _TAIL).cast("int")).over(place))
        joined = pieces.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
        whole = whole.unionByName(joined.select(F.array_join(F.col("p.record"), "\n").alias("record")))
    return whole.select(F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")


def parse(found: DataFrame, columns: int, corrupt: str, sep: str) -> DataFrame:
    """Records parted into text columns _c0, _c1, ... and ``corrupt``, the text
    of a record of too few or too many fields."""
    shape = T.StructType([T.StructField(n, T.StringType()) for n in [*(f"_c{i}" for i in range(columns)), corrupt]])
    how = {"sep": sep, "escape": '"', "multiLine": "true", "lineSep": "\n", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    ddl = ", ".join(f"`{f.name}` string" for f in shape.fields)
    return found.select(F.from_csv("record", ddl, how).alias("r")).select("r.*")


def read_files(spark: SparkSession, path: str, sep: str, multiline: bool = True):
    """(files, read): a row a file with its ``file``, banner and header, and a
    function that reads the files of given paths into ``parse``'s columns."""
    splits = scan_splits(spark, [path], sep, multiline)
    splits, _ = materialize_checked(splits)
    files = splits.filter("block = 0").select("file", "banner", "header").orderBy("file").collect()
    unread = [f.file for f in files if f.header is None]
    if unread:
        raise ValueError(f"the header doesn't end in the first split of {unread[0]}")
    borders, small = materialize_checked(border_splits(splits))
    some = not borders.isEmpty()

    def read(paths: list[str], columns: int, corrupt: str) -> DataFrame:
        found = records(spark, [unquote(p) for p in paths], borders, small, some, sep, multiline)
        return parse(found, columns, corrupt, sep)

    return files, read
