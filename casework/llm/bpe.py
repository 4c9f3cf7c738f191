"""BPE by a compiled automaton (operator 5).

``Automaton`` starts from one state with an arc to itself for every base
symbol.  Merges are taken in order; the gadget of a merge (u, v) -> w: arcs
labelled u end in one state q.  If q has an arc v, u's arcs are redirected to
a copy of q without that arc, and every state with an arc u gets an arc w,
which ends where v's arc of q ended.  All states accept, and the labels along
the only path that spells a word are the word's tokens.

A copy differs from its state by one arc.  So states lie on lines: a line has
one table of the arcs lost along it, with the merge that took each, and a
state is a line up to a merge.  A state that is copied a second time starts a
line of its own that hangs on the first.  Whether a state has the arc w of a
merge (u, v) follows from whether it had arc u when that merge was made.
Transitions in use are kept in a table.

Texts are cut into pieces by Arrow, and each distinct piece of some 2 MB is
looked up once.  Runs of letters below U+0250 are words as they are, in lower
case; other pieces are cut by the tokenizer file's own normalizer and
pre-tokenizer.  Decoding emits the labels of the arcs, joined by the file's (absent) decoder
with a blank.

Defined cases: a null text is empty and has no ids; null and repeated
doc_ids are kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import ChunkEncoder, texts

_CODERS: dict[str, "Coder"] = {}


class Automaton:
    """Deterministic automaton over the symbols of one merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.made: dict[int, tuple[int, int]] = {}  # label: (u, merge)
        self.target: dict[int, int] = {}  # label: state its arcs end in; state 0 for a base symbol at first
        self.lost: list[dict[int, int]] = [{}]  # line: arcs lost, by which merge
        self.hangs: list[tuple[int, int]] = [(-1, -1)]  # line: (line it hangs on, up to which merge)
        self.tip: list[int] = [0]  # line: its last state
        self.state: list[tuple[int, int]] = [(0, -1)]  # state: (line, up to which merge)
        self.base = {i for s, i in vocab.items() if len(s) == 1 or suffix and len(s) == 1 + len(suffix) and s.endswith(suffix)}
        for number, (u, v) in enumerate(merges):
            self._gadget(vocab[u], vocab[v], vocab[u + v], number)
        self.table: dict[tuple[int, int], bool] = {}
        live = {s: i for s, i in vocab.items() if i in self.made or i in self.base}
        self.ends = {s.removesuffix(suffix): i for s, i in live.items() if suffix and s.endswith(suffix)}
        self.inner = {s: i for s, i in live.items() if not (suffix and s.endswith(suffix))}
        if not suffix:
            self.ends = self.inner
        begins = {s[:k] for s in (*self.ends, *self.inner) for k in range(1, len(s))}
        self.walk = dict.fromkeys(begins, -1) | dict.fromkeys(self.ends, -1) | self.inner  # -1: only begins a label

    def _gadget(self, u: int, v: int, w: int, number: int) -> None:
        if w in self.made or w in self.base:
            raise ValueError(f"two merges make token {w}")
        q = self.target.get(u, 0)
        if (u not in self.base and u not in self.made) or (v not in self.base and v not in self.made) or not self._arc(q, v):
            return  # no word holds u before v any more
        end = q if u == v else self.target.get(v, 0)
        line, upto = self.state[q]
        if self.tip[line] != q:
            self.lost.append({})
            self.hangs.append((line, upto))
            self.tip.append(-1)
            line = len(self.lost) - 1
        self.lost[line][v] = number
        self.state.append((line, number))
        self.tip[line] = self.target[u] = len(self.state) - 1
        self.target[w] = end
        self.made[w] = (u, number)

    def _arc(self, state: int, label: int) -> bool:
        """Whether the state has an arc with this label."""
        limit = 1 << 60
        while True:
            line, upto = self.state[state]
            while line >= 0:
                number = self.lost[line].get(label)
                if number is not None and number <= upto and number <= limit:
                    return False
                line, upto = self.hangs[line]
            if label not in self.made:
                return True
            label, limit = self.made[label]  # it was added where u was when the merge was made

    def encode(self, word: str) -> list[int]:
        """Labels of the path that spells the word.  Every beginning of the
        word has one path too; the label that ends at a symbol is the one
        whose arc leaves the state reached before it."""
        n = len(word)
        steps: list[tuple[int, int]] = [(-1, 0)] * (n + 1)  # (last label, where it starts)
        states = [0] * (n + 1)
        step, table, target = self.walk.get, self.table, self.target
        if len(table) > 1_000_000:
            table.clear()
        for start in range(n):
            state = states[start]
            for end in range(start + 1, n + 1):
                label = step(word[start:end])
                if label is None:
                    break
                if end == n:
                    label = self.ends.get(word[start:], -1)
                if label < 0:
                    continue
                key = (state, label)
                go = table.get(key)
                if go is None:
                    go = table[key] = self._arc(state, label)
                if go:
                    steps[end] = (label, start)
                    states[end] = target.get(label, 0)
        out, at = [], n
        while at:
            label, at = steps[at]
            out.append(label)
        return out[::-1]


class Coder(ChunkEncoder):
    """Encoder and decoder of one tokenizer file of the kind this operator
    takes: BPE, no post-processor, no decoder, words ended by white space.
    Texts are cut as ``ChunkEncoder`` does; the automaton gives the ids."""

    def __init__(self, path: str, limit: int = 400_000, longest: int = 60):
        import pyarrow as pa
        super().__init__(path, False, limit, longest)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["post_processor"] or spec["decoder"] or model["ignore_merges"]:
            raise ValueError("not a tokenizer file of the kind handled here")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self._word = self.automaton.encode
        self.normalize, self.cut = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")
        labels = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.labels = pa.array([labels.get(i, "") for i in range(max(labels) + 1)], type=pa.large_string())
        self.decimals = pa.array([str(i) for i in range(len(self.labels))], type=pa.large_string())

    @staticmethod
    def of(path: str) -> "Coder":
        if path not in _CODERS:
            _CODERS[path] = Coder(path)
        return _CODERS[path]

    def _other(self, part: str) -> list[int]:
        out = []
        for piece in self.at_special.split(part):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                for word, _ in self.cut(self.normalize(piece)):
                    out += self.automaton.encode(word)
        return out

    def round_trips(self, texts, most: int = 2_000_000):
        """Arrow arrays (number of ids, the decimal ids joined by blanks, the
        decoded text) of an Arrow column's texts, in order, about ``most``
        bytes at a time.  Decoding takes the labels of the arcs; without a
        decoder in the file, a blank between two."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        blank = pa.scalar(" ", type=pa.large_string())
        for coded in self.encode_slices(texts, most):
            counts = pc.binary_length(coded).to_numpy(zero_copy_only=False) // 4
            ids = pa.array(np.frombuffer(b"".join(coded.to_pylist()), dtype="<u4"))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), type=pa.int64())
            yield pa.array(counts, type=pa.int64()), *(
                pc.binary_join(pa.LargeListArray.from_arrays(offsets, of.take(ids)), blank) for of in (self.decimals, self.labels))

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the decimal ids joined by blanks, the decoded text."""
        import pyarrow as pa
        return tuple(column[0].as_py() for column in next(self.round_trips(pa.array([text]))))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (decimal, joined by one blank),
    decoded.  The automaton is compiled once in each worker process."""
    def run(batches):
        import pyarrow as pa
        coder = Coder.of(tokenizer)
        for batch in batches:
            at = 0
            for counts, ids, decoded in coder.round_trips(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(at, len(counts)), counts, ids.cast(pa.string()), decoded.cast(pa.string())],
                                      names=["doc_id", "n_tokens", "ids", "decoded"])
                at += len(counts)

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string")


def round_trip_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    return round_trip(docs, tokenizer).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                              F.sha2("decoded", 256).alias("decoded_sha256"))
