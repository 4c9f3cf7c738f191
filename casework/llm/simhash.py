"""SimHash near-duplicates by bit-sliced comparison (operator 3).

Fingerprints are made in numpy batches.  Distinct fingerprints are then dealt
into buckets: two that differ in at most 3 bits agree on one of four 16-bit
blocks, and, in the 48 other bits, on one of four groups of 12; so each is
dealt by sixteen keys of 28 bits and no link is lost.  In a bucket the
fingerprints are stored as 64 bit planes.  The planes are compared with
themselves moved by 1, 2, 3, ... places; a carry-save adder counts differing
bits for 64 pairs at a time, and words in which every pair is beyond the
radius are given up.  A bucket passes on a spanning forest of its links.
Buckets of more than ``HOT`` fingerprints are cut into parts, and each pair
of parts becomes a cell of its own.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; a null doc_id counts last when the smallest of a component is
taken (null if there is no other); an empty table gives no rows; repeated
rows and ids are kept, one result per row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.llm.common import small_side, split_hot, texts
from casework.llm.components import components
from casework.session import write_table

WORDS, RADIUS = 3, 3
HOT = 4096


# -- fingerprints ------------------------------------------------------------------

def fingerprints_of(batch: list[str], words: int = WORDS):
    """SimHash of each text, as numpy uint64."""
    import numpy as np
    from xxhash import xxh64_intdigest
    hashes, counts = [], np.zeros(len(batch), dtype=np.int64)
    for i, text in enumerate(batch):
        parts = text.encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII white space parts
        if not parts:
            continue
        if len(parts) <= words:
            hashes.append(xxh64_intdigest(b" ".join(parts), 42))
            counts[i] = 1
            continue
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
        starts = [0, *ends[:-words].tolist()]
        hashes += [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]
        counts[i] = len(starts)
    out = np.zeros(len(batch), dtype=np.uint64)
    if not hashes:
        return out
    own = np.nonzero(counts)[0]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    begin = np.concatenate([[0], np.cumsum(counts[own])[:-1]])
    ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    out[own] = np.packbits(2 * ones > counts[own][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def in_batches(batch: list[str], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about ``most`` characters, or one text."""
    i = 0
    while i < len(batch):
        j, size = i, 0
        while j < len(batch) and (j == i or size + len(batch[j]) <= most):
            size += len(batch[j])
            j += 1
        yield i, j
        i = j


def with_fingerprint(docs: DataFrame, words: int = WORDS, *, text_col: str = "text", name: str = "fp") -> DataFrame:
    """The table with the SimHash of each whole text as a long column."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            for i, j in in_batches([t or "" for t in column.to_pylist()]):
                part = batch.slice(i, j - i)
                marks = fingerprints_of([t or "" for t in part.column(batch.schema.get_field_index(text_col)).to_pylist()], words)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(marks.view("<i8"), type=pa.int64())],
                                                 names=[*part.schema.names, name])

    if name in docs.columns:
        raise ValueError(f"the table has a column {name} already")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


# -- bit-sliced comparison -----------------------------------------------------------

def _planes(marks):
    """64 bit planes of uint64 words: bit i of a plane belongs to mark i."""
    import numpy as np
    n = len(marks)
    bits = np.unpackbits(np.ascontiguousarray(marks, dtype="<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(bits, axis=0, bitorder="little").T  # 64 x bytes
    out = np.zeros((64, (-(-n // 64) + 1) * 8), dtype=np.uint8)
    out[:, :packed.shape[1]] = packed
    return out.view("<u8")


def _moved(planes, by: int):
    """Bit i of the result is bit i + by; ``planes`` ends with a zero word."""
    import numpy as np
    word, bit = divmod(by, 64)
    out = np.zeros_like(planes)
    width = planes.shape[-1] - word
    if width <= 0:
        return out
    out[..., :width] = planes[..., word:] >> np.uint64(bit)
    if bit:
        out[..., :width - 1] |= planes[..., word + 1:] << np.uint64(64 - bit)
    return out


def near_in_place(planes, valid, by: int, radius: int = RADIUS):
    """Word mask of the places i (among ``valid``) whose mark differs from mark
    i + by in at most ``radius`` bits."""
    import numpy as np
    word, bit = divmod(by, 64)
    levels = radius.bit_length()
    words = np.nonzero(valid)[0]
    counters = [np.zeros(len(words), dtype="<u8") for _ in range(levels)]
    beyond = ~valid[words]
    last = planes.shape[1] - 1
    for group in range(0, 64, 8):
        here = planes[group:group + 8][:, words]
        there = planes[group:group + 8][:, np.minimum(words + word, last)] >> np.uint64(bit)
        if bit:
            there |= planes[group:group + 8][:, np.minimum(words + word + 1, last)] << np.uint64(64 - bit)
        differ = here ^ there
        for p in range(0, 8, 2):  # carry-save: two planes and the lowest counter give a sum and one carry
            half = counters[0] ^ differ[p]
            carry = (counters[0] & differ[p]) | (half & differ[p + 1])
            counters[0] = half ^ differ[p + 1]
            for level in range(1, levels):
                counters[level], carry = counters[level] ^ carry, counters[level] & carry
            beyond |= carry
        alive = np.nonzero(~beyond)[0]
        if not len(alive):
            return np.zeros_like(valid)
        if 2 * len(alive) < len(words):  # give up words whose pairs are all beyond the radius
            words, beyond, counters = words[alive], beyond[alive], [c[alive] for c in counters]
    more = np.zeros(len(words), dtype="<u8")  # counter > radius, from the lowest level up
    for level, c in enumerate(counters):
        more = (c | more) if not radius >> level & 1 else (c & more)
    out = np.zeros_like(valid)
    out[words] = ~(beyond | more)
    return out


def forest(marks, groups, radius: int = RADIUS) -> list[tuple[int, int]]:
    """(place, place of its root) for every mark linked, within its group, to an
    earlier one.  ``groups`` is ascending."""
    import numpy as np
    n = len(marks)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.diff(np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]])))
    longest = int(sizes.max()) if n else 0
    size_of = np.repeat(sizes, sizes)
    # groups of like size together, so that a move by many places only meets groups that are as long
    for low, high in ((2, 8), (8, 64), (64, 512), (512, 1 << 62)):
        at = np.flatnonzero((size_of >= low) & (size_of < high))
        if not len(at):
            continue
        planes, own = _planes(marks[at]), groups[at]
        width = planes.shape[1] * 64
        for by in range(1, min(int(size_of[at].max()), longest)):
            same = np.zeros(width, dtype=bool)
            same[:len(at) - by] = own[by:] == own[:-by]
            valid = np.packbits(same, bitorder="little").view("<u8")
            if not valid.any():
                break
            found = np.flatnonzero(np.unpackbits(near_in_place(planes, valid, by, radius).view(np.uint8), bitorder="little"))
            if not len(found):
                continue
            a, b = at[found], at[found + by]
            apart = root[a] != root[b]
            for i, j in zip(a[apart].tolist(), b[apart].tolist()):
                i, j = find(i), find(j)
                if i != j:
                    root[max(i, j)] = min(i, j)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return [(int(i), int(root[i])) for i in np.flatnonzero(root != np.arange(n))]


def _links_in(batches, radius: int = RADIUS):
    """Arrow batches sorted by (bucket, low, high) -> links, group by group."""
    import numpy as np
    import pyarrow as pa

    def out(keys, marks):
        change = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        groups = np.concatenate([[0], np.cumsum(change)])
        pairs = forest(marks, groups, radius)
        signed = marks.view("<i8")
        return pa.record_batch([pa.array([signed[i] for i, _ in pairs], type=pa.int64()),
                                pa.array([signed[j] for _, j in pairs], type=pa.int64())], names=["a", "b"])

    keys, marks = np.zeros((3, 0), dtype=np.int64), np.zeros(0, dtype="<u8")
    for batch in batches:
        new = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
        keys = np.concatenate([keys, new], axis=1)
        marks = np.concatenate([marks, batch.column(3).to_numpy().astype("<i8").view("<u8")])
        if not len(marks):
            continue
        cut = len(marks) - int((keys == keys[:, -1:]).all(axis=0)[::-1].argmin() or len(marks))
        if cut > 0:
            yield out(keys[:, :cut], marks[:cut])
            keys, marks = keys[:, cut:], marks[cut:]
    if len(marks):
        yield out(keys, marks)


def _bucket(fp: Column, block: int, group: int) -> Column:
    """Key of 28 bits: one 16-bit block and a nibble of each other block."""
    key = F.shiftrightunsigned(fp, 16 * block).bitwiseAND(F.lit(0xFFFF).cast("long"))
    for i, other in enumerate(o for o in range(4) if o != block):
        nibble = F.shiftrightunsigned(fp, 16 * other + 4 * group).bitwiseAND(F.lit(15).cast("long"))
        key = key.bitwiseOR(F.shiftleft(nibble, 16 + 4 * i))
    return key.bitwiseOR(F.lit((4 * block + group) << 28).cast("long"))


def fingerprint_links(marks: DataFrame, hot: int = HOT) -> DataFrame:
    """marks (fp long, distinct) -> links (a, b): in every component of the
    graph of fingerprints at most RADIUS bits apart, the links connect it."""
    dealt = marks.select("fp", F.explode(F.array(*[_bucket(F.col("fp"), b, g) for b in range(4) for g in range(4)])).alias("bucket"))
    cells = split_hot(dealt, ["bucket"], "fp", hot).select("bucket", "low", "high", "fp")
    return (cells.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "fp")
            .mapInArrow(_links_in, "a long, b long"))


def classes(marked: DataFrame) -> DataFrame:
    """marked: a written table with doc_id and fp -> (fp, root): the smallest
    fingerprint of the component of each distinct fingerprint."""
    distinct = write_table(marked.select("fp").distinct(), "fingerprints")
    linked = write_table(components(fingerprint_links(distinct)), "fingerprint-roots")
    return distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (hex), component_id."""
    marked = write_table(with_fingerprint(texts(docs)).select("doc_id", "fp"), "simhash")
    roots = write_table(classes(marked), "simhash-classes")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    first = least.join(roots, "fp").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = write_table(roots.join(first, "root").select("fp", "component_id"), "simhash-labels")
    return (marked.join(label, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest doc_id
    (null last; then the first row met) stays, with all its columns."""
    marked = write_table(with_fingerprint(docs, name="__fp").withColumn("__row", F.monotonically_increasing_id()), "simhash-docs")
    roots = classes(marked.select(F.col("__fp").alias("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__row").alias("row"))
    least = marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("first"))
    # rows to go are few beside the rows that stay, so the texts needn't be shuffled to find them
    first = least.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    keep = roots.join(first, "root").select(F.col("fp").alias("__fp"), F.col("first.row").alias("keep"))
    gone = write_table(marked.select("__fp", "__row").join(keep, "__fp").filter(F.col("__row") != F.col("keep")).select("__row"),
                       "simhash-gone")
    return marked.join(small_side(gone, 4_000_000), "__row", "left_anti").select(*docs.columns)
