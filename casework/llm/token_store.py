"""Token ids as compressed binary files (operator 1).

``write_tokens`` deals the documents into ranges of ascending doc_id, encodes
their whole texts, and codes the stream of ids of each range in blocks of
``block_tokens`` ids with the context-mixing range coder.  Each range becomes
one file through Spark's own writer, so a task that is run again after a lost
executor leaves no half-written file behind.

A file is a row of blocks, each: a header (little-endian), a deflated
directory (per document fragment: doc_id, flags, number of ids), the coder's
payload, and a line feed.  Blocks reset the model, know their lengths, and
hold a CRC-32 of directory and payload and one of the ids, both checked by
the reader.

Defined cases: a null text is empty (its ids are the end id alone); a null
doc_id sorts first and comes back null; equal doc_ids stay apart, ordered by
a hash of the text; an empty table gives no files and no rows; other columns
are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casework.llm import context_mix
from casework.llm.common import ChunkEncoder, in_id_order, scratch, shuffle_partitions, small_side, texts

MAGIC = b"CMIX"
HEADER = struct.Struct("<4sIIIIIII")  # magic, file, block, fragments, directory bytes, payload bytes, crc, crc of ids
FRAGMENT = struct.Struct("<qBI")
NULL_ID, GOES_ON = 1, 2
BLOCK_TOKENS = 1 << 20
END_ID = 1


def _block(file: int, number: int, fragments: list[tuple[int | None, bool, int]], ids: bytes) -> bytes:
    import numpy as np
    directory = zlib.compress(b"".join(
        FRAGMENT.pack(0 if doc is None else doc, NULL_ID * (doc is None) | GOES_ON * goes_on, n)
        for doc, goes_on, n in fragments), 1)
    payload = context_mix.compress(np.frombuffer(ids, dtype="<u4"))
    head = HEADER.pack(MAGIC, file, number, len(fragments), len(directory), len(payload),
                       zlib.crc32(payload, zlib.crc32(directory)), zlib.crc32(ids))
    return head + directory + payload


def blocks(file: int, docs: Iterator[tuple[int | None, bytes]], block_tokens: int = BLOCK_TOKENS) -> Iterator[bytes]:
    """Blocks of one file from (doc_id, ids as bytes) in order.  A document
    longer than what is left of a block goes on in the next."""
    held, fragments, size, number = [], [], 0, 0
    for doc, ids in docs:
        at, goes_on = 0, False
        while at < len(ids) or (not goes_on and not ids):
            n = min(len(ids) // 4 - at // 4, block_tokens - size)
            held.append(ids[at:at + 4 * n])
            fragments.append((doc, goes_on, n))
            at, size, goes_on = at + 4 * n, size + n, True
            if size == block_tokens:
                yield _block(file, number, fragments, b"".join(held))
                held, fragments, size, number = [], [], 0, number + 1
            if not ids:
                break
    if fragments:
        yield _block(file, number, fragments, b"".join(held))


def documents_of(data: bytes) -> Iterator[tuple[int, int | None, int, bytes]]:
    """(file, doc_id, start within the file, ids as bytes) from one file's bytes."""
    at, doc, parts, file, start = 0, None, None, 0, 0
    expected = 0
    while at < len(data):
        magic, file, number, n, size_d, size_p, crc, crc_ids = HEADER.unpack_from(data, at)
        at += HEADER.size
        body = memoryview(data)[at:at + size_d + size_p]
        if magic != MAGIC or number != expected or zlib.crc32(body) != crc:
            raise ValueError(f"block {number} of token file {file} is damaged")
        expected += 1
        ids = context_mix.expand(bytes(body[size_d:])).astype("<u4").tobytes()
        if zlib.crc32(ids) != crc_ids:
            raise ValueError(f"ids of block {number} of token file {file} don't match their checksum")
        at += size_d + size_p + 1
        used = 0
        for fragment, flags, count in FRAGMENT.iter_unpack(zlib.decompress(body[:size_d])):
            piece = ids[used:used + 4 * count]
            used += 4 * count
            if flags & GOES_ON:
                parts.append(piece)
                continue
            if parts is not None:
                whole = b"".join(parts)
                yield file, doc, start, whole
                start += len(whole) // 4
            doc, parts = (None if flags & NULL_ID else fragment), [piece]
    if parts is not None:
        yield file, doc, start, b"".join(parts)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = END_ID, partitions: int | None = None,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the ids of every document's whole text, ``end_id`` after each, to
    files below ``path``; one file for each of ``partitions`` id ranges."""
    spark = docs.sparkSession
    ordered = in_id_order(texts(docs), partitions or shuffle_partitions(spark))
    end = array("I", [end_id]).tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = ChunkEncoder.of(tokenizer, led=False)

        def stream():
            for batch in batches:
                for doc, coded in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                    yield doc, coded + end

        for block in blocks(TaskContext.get().partitionId(), stream(), block_tokens):
            yield pa.record_batch([pa.array([block], type=pa.binary())], names=["value"])

    # the writer takes the bytes as they are; a cast from binary to string doesn't look at them
    ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, start_in_file, ids) of every document in the files."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for row in documents_of(data.as_py()):
                    rows.append(row)
                    size += len(row[3])
                    if size > 8_000_000:
                        yield _rows(pa, rows)
                        rows, size = [], 0
                yield _rows(pa, rows)

    def _rows(pa, rows):
        cols = list(zip(*rows)) or [(), (), (), ()]
        return pa.record_batch([pa.array(c, type=t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                               names=["file", "doc_id", "start_in_file", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "file int, doc_id long, start_in_file long, ids binary")


def token_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before.  ``rows``: a written table
    with file, start_in_file, n_tokens.  The running sum is over one row a file."""
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).cast("long").alias("base"))
    return rows.join(small_side(base), "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


def token_table(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write, read back, and describe every document: doc_id, start, n_tokens,
    ids_crc32, file."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    out = scratch(spark, "token-rows")
    (read_tokens(spark, path)
     .select("file", "doc_id", "start_in_file", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
             F.crc32("ids").alias("ids_crc32"))
     .write.parquet(out))
    return token_starts(spark.read.parquet(out)).select("doc_id", "start", "n_tokens", "ids_crc32", "file")
