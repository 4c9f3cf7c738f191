"""Packing documents into sequences (operator 8): best-fit decreasing.

Each scan partition is packed by itself in groups of at most ``group_tokens``
ids, so nothing is shuffled and memory is bounded.  In a group, a document
longer than the window is first cut into full windows, each a sequence of its
own.  What is left of the documents is placed by length, longest first, into
the open sequence with the least room that still holds it; a segment tree
over the remaining capacities 0 to ``window`` finds it in log(window) steps.

Defined cases: a null text is empty (one piece, the end id); null and
repeated doc_ids are kept, one set of pieces per row; an empty table gives no
rows; ties in length are placed in scan order; other columns are ignored.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import ChunkEncoder, texts

WINDOW = 1024
GROUP_TOKENS = 1 << 23
SEQUENCE_BITS = 40  # of a sequence id, below the partition's number


class RoomTree:
    """Stacks of open sequences by remaining capacity; a segment tree of their
    sizes finds the least capacity of at least n that has one."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.held = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.held[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, sequence) with the least capacity >= ``least``, taken out."""
        node = least + self.leaves
        if not self.held[node]:
            # climb to the first right neighbour that holds something, then go down on its left
            while node > 1 and (node & 1 or not self.held[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.held[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.open[room].pop()
        while node:
            self.held[node] -= 1
            node >>= 1
        return room, sequence


def place(lengths: list[int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) and the number of
    sequences, for documents of the given lengths (each at least 1)."""
    pieces, rests, n = [], [], 0
    for doc, length in enumerate(lengths):
        full = length // window * window
        for start in range(0, full, window):
            pieces.append((doc, start, window, n, 0))
            n += 1
        if length > full:
            rests.append((full - length, doc, full))
    rests.sort()
    tree = RoomTree(window)
    for minus, doc, start in rests:
        found = tree.take(-minus)
        room, sequence = found if found else (window, n)
        n += not found
        pieces.append((doc, start, -minus, sequence, window - room))
        if room + minus:
            tree.put(room + minus, sequence)
    return pieces, n


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = 0, window: int = WINDOW, group_tokens: int = GROUP_TOKENS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset."""
    end = array("I", [end_id]).tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = ChunkEncoder.of(tokenizer, led=True)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def flush():
            nonlocal base
            pieces, n = place([len(ids) // 4 for _, ids in held], window)
            pieces.sort(key=lambda p: (p[3], p[4]))
            for i in range(0, len(pieces), 20_000):
                part = pieces[i:i + 20_000]
                yield pa.record_batch([
                    pa.array([held[p[0]][0] for p in part], type=pa.int64()),
                    pa.array([p[1] for p in part], type=pa.int64()),
                    pa.array([p[2] for p in part], type=pa.int64()),
                    pa.array([held[p[0]][1][4 * p[1]:4 * (p[1] + p[2])] for p in part], type=pa.binary()),
                    pa.array([len(held[p[0]][1]) // 4 for p in part], type=pa.int64()),
                    pa.array([base + p[3] for p in part], type=pa.int64()),
                    pa.array([p[4] for p in part], type=pa.int64()),
                ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            base += n

        for batch in batches:
            for doc, coded in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                held.append((doc, coded + end))
                size += len(coded) // 4 + 1
                if size >= group_tokens:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def packed_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pack(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                        "sequence_id", "offset")
