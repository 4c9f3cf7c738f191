"""MinHash fingerprints of documents (operator 10).

Words are runs without ASCII white space, A-Z lower-cased; shingles are five
words (a shorter text is one shingle, a text without words none).  A shingle's
number is made from its words' hashes by multiplication and addition in
64 bits, and each of ``PERMUTATIONS`` universal hashes (odd multiplier, added
number, upper 32 bits) keeps its least value, all in numpy.  The likeness of
two fingerprints is their share of equal values (1 for two texts without
words, 0 if only one has none).

``near_next`` and the edited text need the next document, in ascending
doc_id.  Documents are dealt into ranges and sorted; a task holds one document
back until it has seen the next.  The last document of a range meets the first
of the next range that isn't empty in a join of one row a range.

``near_classes`` joins bands of the signatures and verifies the Jaccard
similarity of five-word shingles (0.8 or more).

Defined cases: a null text is empty; a null doc_id sorts first, equal ids by a
hash of the text; a table of one document has itself as the next; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casework.llm.common import in_id_order, scratch, shuffle_partitions, split_hot, texts
from casework.llm.components import components
from casework.session import write_table

WORDS, PERMUTATIONS, BANDS, LIKE, HOT = 5, 64, 16, 0.8, 512
NONE = 0xFFFFFFFF  # value of every permutation for a text without words
_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


class Hasher:
    """Word numbers kept by word, and the permutations."""

    def __init__(self, seed: int = 7, limit: int = 600_000):
        import numpy as np
        draw = np.random.default_rng(seed)
        self.times = (draw.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.plus = draw.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
        self.place = (draw.integers(0, 1 << 63, WORDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.limit = limit
        self.kept: dict[bytes, int] = {}

    def words(self, words: list[bytes]):
        import numpy as np
        from xxhash import xxh64_intdigest
        kept = self.kept
        try:
            return np.fromiter(map(kept.__getitem__, words), dtype=np.uint64, count=len(words))
        except KeyError:
            if len(kept) > self.limit:
                kept.clear()
            long = {}
            for w in set(words).difference(kept):
                (kept if len(w) <= 60 else long)[w] = xxh64_intdigest(w, 11)
            every = {**long, **{w: kept[w] for w in set(words) if w in kept}} if long else kept
            return np.fromiter(map(every.__getitem__, words), dtype=np.uint64, count=len(words))

    def shingles(self, numbers):
        """Numbers of the shingles of a row of word numbers."""
        import numpy as np
        n = len(numbers)
        if not n:
            return numbers
        span = min(WORDS, n)
        out = np.zeros(n - span + 1, dtype=np.uint64)
        for k in range(span):
            out += numbers[k:n - span + 1 + k] * self.place[k]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))

    def least(self, shingles):
        """The least value of each permutation, uint32."""
        import numpy as np
        out = np.full(PERMUTATIONS, NONE, dtype=np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[None, at:at + 2048] * self.times[:, None]
            part += self.plus[:, None]
            np.minimum(out, part.min(axis=1) >> np.uint64(32), out=out)
        return out.astype(np.uint32)


_HASHERS: list[Hasher] = []


def hasher() -> Hasher:
    if not _HASHERS:
        _HASHERS.append(Hasher())
    return _HASHERS[0]


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII white space parts


def signature(text: str):
    h = hasher()
    return h.least(h.shingles(h.words(split_words(text))))


def likeness(a, b) -> float:
    return float((a == b).mean())


def written(sig) -> str:
    return sig.astype(">u4").tobytes().hex()


class Held:
    """A document with what can be said about it before the next is known."""

    def __init__(self, doc_id: int | None, text: str):
        h = hasher()
        self.doc_id, self.text, self.n = doc_id, text, len(text)
        words = split_words(text)
        self.numbers = h.words(words)
        self.stay = self.text[:self.n - self.n // 4]
        stay = split_words(self.stay)
        self.cut = stay[-1] if stay else b""
        self.open = bool(stay) and not self.stay[-1] in " \t\n\x0b\x0c\r"  # the cut may go through a word
        # words before the last one of what stays are in the edited text as well
        self.same = max(len(stay) - 1, 0)
        shared = self.numbers[:self.same]
        whole = h.shingles(self.numbers)
        if self.same >= WORDS:
            first = h.least(whole[:self.same - WORDS + 1])
            self.shared = first
            import numpy as np
            self.sig = np.minimum(first, h.least(whole[self.same - WORDS + 1:]))
        else:
            self.shared = None
            self.sig = h.least(whole)
        self.before = shared[-(WORDS - 1):] if self.shared is not None else shared

    def row(self, after: "Held") -> tuple:
        import numpy as np
        h = hasher()
        head = after.text[:self.n // 4]
        tail = split_words((self.cut.decode("utf-8") + ("" if self.open else " ") + head) if self.cut else head)
        numbers = np.concatenate([self.before, h.words(tail)])
        edited = h.least(h.shingles(numbers)) if self.shared is None or len(numbers) >= WORDS else h.least(numbers[:0])
        if self.shared is not None:
            edited = np.minimum(edited, self.shared)
        digest = hashlib.sha256((self.stay + head).encode("utf-8")).hexdigest()
        return (self.doc_id, self.n, digest, written(self.sig), written(edited), likeness(self.sig, edited),
                likeness(self.sig, after.sig))


def _batch(pa, rows: list[tuple], schema):
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """The contract's row per document, through two passes: within ranges, then
    across their borders."""
    def arrow(pa, more=()):
        fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
        return pa.schema([*fields, *more])

    def within(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        schema = arrow(pa, [("range", pa.int32()), ("kind", pa.string()), ("text", pa.string())])
        none = (None,) * 6
        held, rows = None, []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = Held(doc_id, text)
                rows.append((doc_id, *none, part, "first", text) if held is None else (*held.row(now), part, "row", None))
                held = now
                if len(rows) >= 5000:
                    yield _batch(pa, rows, schema)
                    rows = []
        if held is not None:
            rows.append((held.doc_id, *none, part, "last", held.text))
        if rows:
            yield _batch(pa, rows, schema)

    def across(batches):
        import pyarrow as pa
        for batch in batches:
            rows = [Held(d, t).row(Held(None, u)) for d, t, u in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            if rows:
                yield _batch(pa, rows, arrow(pa))

    ordered = in_id_order(texts(docs), shuffle_partitions(docs.sparkSession))
    path = scratch(docs.sparkSession, "minhash-rows")
    (ordered.mapInArrow(within, _RESULT + ", range int, kind string, text string")
     .write.option("compression", "zstd").parquet(path))  # hexadecimal text: half of it goes
    found = docs.sparkSession.read.parquet(path)
    first = found.filter("kind = 'first'")
    by_range = Window.orderBy("range")  # one row a range
    before = first.select(F.col("text").alias("next"), F.coalesce(
        F.lag("range").over(by_range), F.max("range").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .alias("of"))
    border = (found.filter("kind = 'last'").join(before, F.col("range") == F.col("of")).select("doc_id", "text", "next")
              .mapInArrow(across, _RESULT))
    names = [f.split()[0] for f in _RESULT.split(", ")]
    return found.filter("kind = 'row'").select(*names).unionByName(border)


def near_classes(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """(doc_id, class_id): class_id is the smallest doc_id among documents linked
    by Jaccard similarity of their five-word shingles of at least ``like``.

    Equal texts are one text.  Texts that share a band meet in one group, where
    each is verified against those before it that aren't in its class yet, and
    only a spanning forest of links leaves.  A group of more than ``HOT`` texts
    is cut into parts, each pair of which is a group of its own, so a task holds
    at most two parts.
    """
    rows_of = PERMUTATIONS // BANDS

    def sign(batches):
        import numpy as np
        import pyarrow as pa
        h = hasher()
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shingles = np.unique(h.shingles(h.words(split_words(text))))
                sig = h.least(shingles).reshape(BANDS, rows_of).astype("<u4")
                out += [(b, int.from_bytes(hashlib.blake2b(sig[b].tobytes(), digest_size=8).digest(), "little", signed=True),
                         key, shingles.tobytes()) for b in range(BANDS)]
                if len(out) > 20_000:
                    yield _pairs(pa, out)
                    out = []
            if out:
                yield _pairs(pa, out)

    def _pairs(pa, out):
        b, band, key, shingles = zip(*out)
        return pa.record_batch([pa.array(b, type=pa.int32()), pa.array(band, type=pa.int64()), pa.array(key, type=pa.int64()),
                                pa.array(shingles, type=pa.binary())], names=["b", "band", "key", "shingles"])

    def verify(batches):
        import numpy as np
        import pyarrow as pa
        at, group = None, []
        for batch in batches:
            links = []
            for b, band, key, shingles, low, high in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (b, band, low, high) != at:
                    at, group = (b, band, low, high), []
                mine = np.frombuffer(shingles, dtype=np.uint64)
                root = None
                for other in group:  # (root, key, shingles)
                    if other[0] is root:
                        continue
                    n = len(np.intersect1d(mine, other[2], assume_unique=True))
                    union = len(mine) + len(other[2]) - n
                    if (n >= like * union) if union else True:
                        links.append((key, other[1]))
                        if root is None:
                            root = other[0]
                        else:
                            merged, root = other[0], root
                            group = [(root if g[0] is merged else g[0], *g[1:]) for g in group]
                group.append((root or object(), key, mine))
            if links:
                a, b2 = zip(*links)
                yield pa.record_batch([pa.array(a, type=pa.int64()), pa.array(b2, type=pa.int64())], names=["a", "b"])

    marked = write_table(texts(docs).withColumn("key", F.xxhash64("text")), "minhash-texts")
    distinct = marked.groupBy("key").agg(F.any_value("text").alias("text"))
    banded = distinct.mapInArrow(sign, "b int, band long, key long, shingles binary")
    banded = write_table(banded, "minhash-bands")
    links = (split_hot(banded, ["b", "band"], "key", HOT).select("b", "band", "key", "shingles", "low", "high")
             .repartition("b", "band", "low", "high").sortWithinPartitions("b", "band", "low", "high", "key")
             .mapInArrow(verify, "a long, b long"))
    roots = write_table(components(links), "minhash-roots")
    keyed = marked.select("doc_id", "key").join(roots, F.col("key") == F.col("node"), "left").select(
        "doc_id", F.coalesce("root", "key").alias("root"))
    keyed = write_table(keyed, "minhash-keyed")
    return keyed.join(keyed.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("doc_id", "class_id")
