"""Substring dedup by Rabin-Karp windows (operator 11).

Every window of ``WINDOW`` consecutive words of a document has a polynomial
hash.  A word leaves if a window that covers it also starts earlier: in a
document of a smaller doc_id, or in the same document further left.

Documents are put in doc_id order and cut into chunks of whole documents, in a
table bucketed by chunk, so that what the counting says of a chunk comes to
its texts without shuffling them again.  Windows are counted in two rounds:

* every chunk sends its distinct hashes, 53 bits of each, as sorted sets
  (Elias-Fano coded, about 4.3 bytes a window), dealt by their leading bits;
  a bit a hash comes back: another chunk has it too;
* windows so marked send 96 bits of two polynomials; a bit comes back: an
  earlier chunk has it too.

Of a chunk's equal windows only one is ever sent, so a passage that is
everywhere costs one entry a chunk.  Repeated windows then merge into maximal
intervals, and these are cut out.

Defined cases: a null or empty text has no words; a null doc_id sorts first;
of rows alike in doc_id the one with the smaller hash of its text, then the
smaller text, is earlier, and of rows alike in both any one; texts of fewer
words than a window stay whole; an empty table gives no rows; other columns
are ignored, so no name can clash.  A document is one row, so a task holds at
least one whole document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import in_id_order, scratch, shuffle_partitions, texts
from casework.session import write_table

WINDOW = 20
CHUNK_BYTES = 24 << 20   # text of a chunk, at least one document
BUCKET_BYTES = 16 << 20  # text whose windows meet in one bucket, about
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two polynomials
SIGN_BASE = 0xD6E8FEB86659FD95  # of the polynomial over a word's bytes; longer words are hashed by xxHash
LONG = 64
TURN = 2 << 20           # bytes whose words are hashed at a time, at least one document
LOW = 32                 # bits of a hash that are stored as they are
FIRST = 53               # bits of a hash in the first round

CHUNKED = "chunk long, at long, doc_id long, text string"
SETS = "bucket long, chunk long, n long, data binary"
REPLY = "chunk long, bucket long, bits binary"
OUT = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string"


# -- hashes of a chunk's windows -----------------------------------------------------

def word_hashes(data: bytes):
    """64-bit hash of every word of some text, and where the words start."""
    import numpy as np
    from xxhash import xxh64_intdigest
    signs = np.frombuffer(data, dtype=np.uint8)
    gap = np.ones(len(signs) + 2, dtype=bool)
    gap[1:-1] = (signs == 32) | ((signs >= 9) & (signs <= 13))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    order = np.argsort(-sizes, kind="stable")  # longest first: those that have a k-th sign are the first few
    at, size = starts[order], sizes[order]
    h = size.astype(np.uint64)
    for k in range(min(int(size[0]), LONG) if len(size) else 0):
        n = np.searchsorted(-size, -k, side="left")
        h[:n] *= np.uint64(SIGN_BASE)
        h[:n] += signs[at[:n] + k]
    for i in range(int(np.searchsorted(-size, -LONG, side="left"))):
        h[i] = xxh64_intdigest(data[at[i]:at[i] + size[i]], 11)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    out = np.empty_like(h)
    out[order] = h
    return out, starts


class Windows:
    """Hashes of all windows of a chunk's documents, in order of (document, start)."""

    def __init__(self, docs: list[str | None], window: int):
        import numpy as np
        hashes, sizes, held, room = [], [], [], 0
        for i, text in enumerate(docs):
            held.append((text or "").encode("utf-8"))
            room += len(held[-1])
            if room > TURN or i == len(docs) - 1:  # several documents at a time
                h, starts = word_hashes(b"\n".join(held))
                ends = np.cumsum([len(t) + 1 for t in held])
                sizes.append(np.diff(np.searchsorted(starts, ends), prepend=0))
                hashes.append(h)
                held, room = [], 0
        flat = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes  # first word of each document
        n = max(0, len(flat) - window + 1)
        left = np.repeat(self.first + self.sizes, self.sizes)[:n] - np.arange(n)  # words left in the document
        self.starts = np.flatnonzero(left >= window)
        made = []
        for base in BASES:
            h = np.zeros(n, dtype=np.uint64)
            for k in range(window if n else 0):
                h *= np.uint64(base)
                h += flat[k:k + n]
            h ^= h >> np.uint64(29)  # the lowest bits of a product depend on few others
            made.append((h * np.uint64(BASES[0]))[self.starts])
        one, two = made
        two >>= np.uint64(32)
        order = np.argsort(one, kind="stable")
        a, b = one[order], two[order]
        if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
            order = np.lexsort((np.arange(len(one)), two, one))
            a, b = one[order], two[order]
        self.order, self.one, self.two = order, a, b  # sorted by (hash, hash, start)
        self.new = np.ones(len(a), dtype=bool)  # the first window of each pair of hashes
        self.new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        short = a >> np.uint64(64 - FIRST)
        self.new_short = np.ones(len(a), dtype=bool)
        self.new_short[1:] = short[1:] != short[:-1]
        self.keys = short[self.new_short]  # sorted distinct first-round hashes

    def marked(self, bits):
        """Mask of the sorted windows that are sent in the second round: the
        first of each pair of hashes whose first-round hash has its bit set."""
        import numpy as np
        return self.new & bits[np.cumsum(self.new_short) - 1]

    def repeated(self, sent, earlier):
        """Mask of the windows, in order of start, that also start earlier.
        sent: ``marked``; earlier: of each one sent, an earlier chunk has it."""
        import numpy as np
        elsewhere = np.zeros(len(self.order), dtype=bool)
        elsewhere[np.flatnonzero(sent)[earlier]] = True
        out = np.empty(len(self.order), dtype=bool)
        out[self.order] = ~self.new | elsewhere  # all but the first of a pair are repeated within the chunk
        return out


def covered(windows: Windows, mask, window: int):
    """Mask of the chunk's words that a masked window covers."""
    import numpy as np
    edge = np.zeros(int(windows.sizes.sum()) + 1, dtype=np.int32)
    at = windows.starts[mask]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


# -- sorted sets ----------------------------------------------------------------------

def pack_set(values, high_values: int) -> bytes:
    """Elias-Fano: low bits as they are, high ones in unary.  values: sorted
    uint64 below high_values << LOW."""
    import numpy as np
    marks = np.zeros(len(values) + high_values, dtype=bool)
    marks[(values >> np.uint64(LOW)).astype(np.int64) + np.arange(len(values))] = True
    return values.astype("<u4").tobytes() + np.packbits(marks).tobytes()


def unpack_set(data: bytes, n: int):
    import numpy as np
    low = np.frombuffer(data, dtype="<u4", count=n).astype(np.uint64)
    marks = np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=4 * n))
    high = np.flatnonzero(marks) - np.arange(n)
    return (high.astype(np.uint64) << np.uint64(LOW)) | low


# -- the two rounds ---------------------------------------------------------------------

def _chunked(docs: DataFrame) -> DataFrame:
    """The documents in order, cut into chunks: a table bucketed by chunk."""
    spark, n = docs.sparkSession, shuffle_partitions(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        task, held, at, number = TaskContext.get().partitionId() << 32, 0, 0, 0
        for batch in batches:
            size = pc.binary_length(batch.column(1).cast(pa.large_binary())).to_numpy(zero_copy_only=False)
            chunk, place = np.empty(len(size), dtype=np.int64), np.empty(len(size), dtype=np.int64)
            for i, s in enumerate(size):
                if held and held + s > CHUNK_BYTES:
                    held, at, number = 0, 0, number + 1
                chunk[i], place[i] = task + number, at
                held, at = held + int(s), at + 1
            yield pa.record_batch([pa.array(chunk), pa.array(place), batch.column(0), batch.column(1)],
                                  names=["chunk", "at", "doc_id", "text"])

    path, name = scratch(spark, "chunks"), f"chunks_{uuid.uuid4().hex}"
    (in_id_order(texts(docs), n).mapInArrow(run, CHUNKED).write.bucketBy(n, "chunk")
     .option("path", path).option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def _texts_of(table) -> tuple[list, list]:
    table = table.sort_by("at")
    return table.column("doc_id").to_pylist(), table.column("text").to_pylist()


def _bits_of(replies, counts) -> "np.ndarray":  # noqa: F821
    """Bits of all buckets in a row; counts: entries of each bucket."""
    import numpy as np
    got = dict(zip(replies.column("bucket").to_pylist(), replies.column("bits").to_pylist()))
    parts = [np.unpackbits(np.frombuffer(got[b], dtype=np.uint8), count=int(c)) for b, c in enumerate(counts) if c]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, dtype=bool)


def _cuts(top, buckets: int):
    """Bounds of the buckets in an array sorted by bucket."""
    import numpy as np
    return np.searchsorted(top, np.arange(buckets + 1).astype(top.dtype))


def _replies(sets: DataFrame, buckets: int, decode, alike) -> DataFrame:
    """A bit for every entry sent, per (chunk, bucket).  decode(data, n) -> keys
    in sorted order (a tuple of arrays, most significant first);
    alike(same_as_before) -> mask, over the bucket's entries sorted by (key, chunk)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def answer(bucket, rows):
            keys = [decode(data, n) for _, n, data in rows]
            chunk = np.repeat([c for c, _, _ in rows], [n for _, n, _ in rows])
            columns = [np.concatenate(k) for k in zip(*keys)]
            order = np.lexsort((chunk, *reversed(columns)))
            same = np.zeros(len(order) + 1, dtype=bool)
            same[1:-1] = np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in columns])
            mask = np.empty(len(order), dtype=bool)
            mask[order] = alike(same)
            at = np.cumsum([0] + [n for _, n, _ in rows])
            return pa.record_batch([pa.array([c for c, _, _ in rows], type=pa.int64()), pa.array([bucket] * len(rows), type=pa.int64()),
                                    pa.array([np.packbits(mask[i:j]).tobytes() for i, j in zip(at, at[1:])], type=pa.binary())],
                                   names=["chunk", "bucket", "bits"])

        now, rows = None, []
        for batch in batches:
            for bucket, chunk, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now and rows:
                    yield answer(now, rows)
                    rows = []
                now = bucket
                rows.append((chunk, n, data))
        if rows:
            yield answer(now, rows)

    n = min(buckets, 4 * shuffle_partitions(sets.sparkSession))
    return write_table(sets.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, REPLY), "window-replies")


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, kept): of every document its words, the
    maximal intervals of words to remove (end exclusive), and the words that
    stay, joined by one space."""
    table = _chunked(docs)
    size = table.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    bits = max(4, (size // BUCKET_BYTES).bit_length())
    buckets = 1 << bits
    slots = 1 << max(0, FIRST - bits - LOW)
    rest = FIRST - bits

    def send(docs_of_chunk):
        import numpy as np
        import pyarrow as pa
        chunk = docs_of_chunk.column("chunk")[0].as_py()
        keys = Windows(_texts_of(docs_of_chunk)[1], window).keys
        cuts, low = _cuts(keys >> np.uint64(rest), buckets), keys & np.uint64((1 << rest) - 1)
        rows = [(b, chunk, int(j - i), pack_set(low[i:j], slots)) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        return _table(pa, SETS, rows)

    def again(key, docs_of_chunk, replies):
        import numpy as np
        import pyarrow as pa
        if not docs_of_chunk.num_rows:
            return _table(pa, SETS, [])
        chunk = docs_of_chunk.column("chunk")[0].as_py()
        found, sent = _sent(docs_of_chunk, replies, "first")
        a, b = found.one[sent], found.two[sent].astype("<u4")
        cuts = _cuts(a >> np.uint64(64 - bits), buckets)
        rows = [(k, chunk, int(j - i), a[i:j].astype("<u8").tobytes() + b[i:j].tobytes())
                for k, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        return _table(pa, SETS, rows)

    def _sent(docs_of_chunk, replies, kind):
        import numpy as np
        import pyarrow.compute as pc
        found = Windows(_texts_of(docs_of_chunk)[1], window)
        cuts = _cuts(found.keys >> np.uint64(rest), buckets)
        mine = replies.filter(pc.equal(replies.column("kind"), kind))
        return found, found.marked(_bits_of(mine, np.diff(cuts)))

    def cut(key, docs_of_chunk, replies):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not docs_of_chunk.num_rows:
            return _table(pa, None, [])
        ids, whole = _texts_of(docs_of_chunk)
        found, sent = _sent(docs_of_chunk, replies, "first")
        counts = np.diff(_cuts(found.one[sent] >> np.uint64(64 - bits), buckets))
        earlier = _bits_of(replies.filter(pc.equal(replies.column("kind"), "second")), counts)
        gone = covered(found, found.repeated(sent, earlier), window)
        rows = []
        for doc, text, at, n in zip(ids, whole, found.first.tolist(), found.sizes.tolist()):
            mask = gone[at:at + n]
            words = (text or "").encode("utf-8").split()
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))).tolist()
            kept = words if not edges else [w for w, m in zip(words, mask.tolist()) if not m]
            rows.append((doc, n, [{"start": i, "end": j} for i, j in zip(edges[::2], edges[1::2])], b" ".join(kept).decode("utf-8")))
        return _table(pa, None, rows)

    def second_key(data, n):
        import numpy as np
        return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n)

    first = _replies(table.groupBy("chunk").applyInArrow(send, SETS), buckets, lambda data, n: (unpack_set(data, n),),
                     lambda same: same[1:] | same[:-1]).withColumn("kind", F.lit("first"))
    by_chunk = table.groupBy("chunk")
    second = _replies(by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(again, SETS), buckets, second_key,
                      lambda same: same[:-1]).withColumn("kind", F.lit("second"))
    return by_chunk.cogroup(first.unionByName(second).groupBy("chunk")).applyInArrow(cut, OUT)


def _table(pa, kind, rows):
    types = ([("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())] if kind else
             [("doc_id", pa.int64()), ("n_words", pa.int64()),
              ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.table([pa.array(c, type=t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])


def repeat_table(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return repeats(docs, window).select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"),
                                        F.size("spans").alias("n_spans"))
