"""Quality of documents by attention-based multiple-instance learning (operator 2).

A document is a bag of passages of 64 words.  A passage is encoded as the mean
of its words' shape features, the share of words new to the document, and its
length.  A word over 40 characters takes the place of a word for each 8 of
them, and one over 512 (a text without white space, say) is cut into stretches
of 512, each a word.  A hidden layer, gated attention (a tanh layer times a sigmoid layer)
and a logistic output on the attention-weighted passages are trained together
from the labels of whole documents by Adam, in numpy on the driver, on a
bounded sample of labelled rows: the first ``MAX_TRAIN`` by a hash of doc_id
(then doc_id, label and passages, where ids repeat), of these, in that order,
every row that still fits into ``MAX_PASSAGES`` passages in all, each with all
its passages.  Scoring is distributed, over all passages of whole texts, and
sees the text alone.

Defined cases: a null or empty text is one empty passage and gets its score; a
null doc_id is not held out and never trains; of several labels of one id the
smallest counts, null labels don't; without two classes of labels every score
is the labels' mean, 0.5 if there are none; an empty table gives no rows;
repeated rows are scored one by one.
"""

from __future__ import annotations

import string
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import one_store, texts
from casework.session import write_table

PASSAGE, THRESHOLD = 64, 0.3
LETTERS = 8  # characters of a long word that take the place of one word of a passage
MAX_TRAIN, MAX_PASSAGES = 6000, 200_000
HASHED, SHAPES = 20, 10
WIDTH = SHAPES + HASHED + 2
HIDDEN, GATE = 24, 12
_MARKS = string.punctuation


# -- passages ------------------------------------------------------------------------

def word_features(word: str) -> list[float]:
    """Shape of a word, and one of HASHED buckets if it is short."""
    core = word.strip(_MARKS)
    after = len(word) - len(word.rstrip(_MARKS))
    out = [0.0] * (SHAPES + HASHED)
    out[0] = float(word.isalpha())
    out[1] = float(after == 1)
    out[2] = float(after >= 2)
    out[3] = float(len(core) > 1 and core.isupper())
    out[4] = float(core[:1].isupper())
    out[5] = float(not core)
    out[6] = float(any(map(str.isdigit, core)))
    out[7] = min(len(word), 40) / 10
    out[8] = float(len(core) <= 3)
    out[9] = float(len(core) > 12)
    if len(core) <= 4:
        out[SHAPES + zlib.crc32(core.lower().encode()) % HASHED] = 1.0
    return out


def stretches(words: list[str], longest: int) -> tuple[list[str], list[int]]:
    """Words, those over a passage's characters in stretches of so many, and the
    share of a passage that each takes, in words."""
    out = []
    for w in words:
        out += [w] if len(w) <= PASSAGE * LETTERS else [w[i:i + PASSAGE * LETTERS] for i in range(0, len(w), PASSAGE * LETTERS)]
    return out, [1 if len(w) <= longest else -(-len(w) // LETTERS) for w in out]


class Encoder:
    """Passage vectors of texts; features of words of up to ``longest`` characters
    are kept by word, emptied at ``limit``."""

    def __init__(self, limit: int = 100_000, longest: int = 40):
        import numpy as np
        self.limit, self.longest = limit, longest
        self.rows: dict[str, int] = {}
        self.table = np.zeros((limit + 1, SHAPES + HASHED), dtype=np.float32)

    def _numbers(self, words: list[str]):
        """Number of each word, and the features by number: those of the table,
        then those of the longer words."""
        import numpy as np
        distinct = set(words)
        long = {w: self.limit + 1 + i for i, w in enumerate(w for w in distinct if len(w) > self.longest)}
        new = distinct.difference(self.rows, long)
        if len(self.rows) + len(new) > self.limit:
            self.rows.clear()
            new = distinct.difference(long)
            if len(new) > self.limit:
                raise ValueError("more distinct words in one text than the table holds")
        for w in new:
            self.table[len(self.rows)] = word_features(w)
            self.rows[w] = len(self.rows)
        if not long:
            return np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words)), self.table.__getitem__
        extra = np.array([word_features(w) for w in long], dtype=np.float32)

        def features(at):
            out = self.table[np.minimum(at, self.limit)]
            out[at > self.limit] = extra[at[at > self.limit] - self.limit - 1]
            return out

        return np.fromiter((long[w] if w in long else self.rows[w] for w in words), dtype=np.int64, count=len(words)), features

    def passages(self, text: str):
        """(passages, WIDTH) float32, of all characters of the text."""
        import numpy as np
        words = text.split()
        if not words:
            return np.zeros((1, WIDTH), dtype=np.float32)
        starts = np.arange(0, len(words), PASSAGE)
        counts = np.diff(np.append(starts, len(words))).astype(np.float32)
        taken = counts
        if max(map(len, words)) > self.longest:
            words, units = stretches(words, self.longest)
            starts, room = [], 0
            for i, n in enumerate(units):
                if n > room:
                    starts.append(i)
                    room = PASSAGE
                room -= n
            starts = np.array(starts)
            counts = np.diff(np.append(starts, len(words))).astype(np.float32)
            taken = np.add.reduceat(np.array(units, dtype=np.float32), starts)
        out = np.empty((len(starts), WIDTH), dtype=np.float32)
        out[:, -1] = taken / PASSAGE
        bounds, seen, at = np.append(starts, len(words)), set(), 0
        while at < len(starts):  # a text of very many words in turns
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + self.limit // 2, side="right")) - 1)
            part = words[bounds[at]:bounds[to]]
            numbers, features = self._numbers(part)
            first = np.unique(numbers, return_index=True)[1]
            if to - at < len(starts):  # new to the whole text, not to the part
                first = [i for i in first.tolist() if part[i] not in seen]
                seen.update(part[i] for i in first)
            new = np.zeros(len(part), dtype=np.float32)
            new[first] = 1
            inner = starts[at:to] - bounds[at]
            out[at:to, :-2] = np.add.reduceat(features(numbers), inner, axis=0) / counts[at:to, None]
            out[at:to, -2] = np.add.reduceat(new, inner) / counts[at:to]
            at = to
        return out


def encoder() -> Encoder:
    return one_store(("passages",), Encoder)


# -- the model -------------------------------------------------------------------------

class Model:
    """Gated-attention pooling over passages; ``constant`` if it can't be trained."""

    def __init__(self, constant: float | None = None, seed: int = 3):
        import numpy as np
        self.constant = constant
        draw = np.random.default_rng(seed)
        layer = lambda a, b: draw.normal(0, a ** -0.5, (a, b))
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)
        self.p = {"w": layer(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "v": layer(HIDDEN, GATE), "u": layer(HIDDEN, GATE),
                  "a": layer(GATE, 1), "c": layer(HIDDEN, 1), "d": np.zeros(1)}

    def forward(self, x, starts):
        import numpy as np
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.maximum(x @ p["w"] + p["b"], 0)
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        s = ((t * g) @ p["a"])[:, 0]
        counts = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), counts)
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        weight = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(h * weight[:, None], starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip((z @ p["c"])[:, 0] + p["d"][0], -30, 30)))
        return y, (x, h, t, g, weight, bag, z)

    def scores(self, bags: list):
        """Scores of bags (arrays of passages)."""
        import numpy as np
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return self.forward(np.concatenate(bags), starts)[0]

    def gradient(self, x, starts, label):
        import numpy as np
        p = self.p
        y, (x, h, t, g, weight, bag, z) = self.forward(x, starts)
        off = (y - label) / len(label)
        dz = off[:, None] @ p["c"].T
        dw = (dz[bag] * h).sum(1)
        ds = weight * (dw - np.add.reduceat(weight * dw, starts)[bag])
        dtg = ds[:, None] @ p["a"].T
        dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
        dh = (dz[bag] * weight[:, None] + dt @ p["v"].T + dg @ p["u"].T) * (h > 0)
        return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ ds[:, None],
                "c": z.T @ off[:, None], "d": off.sum(keepdims=True)}


def fit(bags: list, labels, *, rounds: int = 30, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model:
    import numpy as np
    labels = np.asarray(labels, dtype=float)
    if len(set(labels.tolist())) < 2:
        return Model(float(labels.mean()) if len(labels) else 0.5)
    model, draw = Model(), np.random.default_rng(seed)
    every = np.concatenate(bags)
    model.mean, model.scale = every.mean(0), every.std(0) + 1e-3
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for turn in range(rounds):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            starts = np.cumsum([0, *(len(bags[i]) for i in part[:-1])])
            grads = model.gradient(np.concatenate([bags[i] for i in part]).astype(float), starts, labels[part])
            step += 1
            for k, g in grads.items():
                g = g + decay * model.p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.p[k] -= (rate * 0.95 ** turn * first[k] / (1 - 0.9 ** step)
                               / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8))
    return model


# -- on Spark --------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, max_passages: int = MAX_PASSAGES) -> Model:
    """Fit on labelled documents that aren't held out."""
    import numpy as np
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
             .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = texts(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")  # at most max_train rows

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            made = [encoder().passages(text) for text in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1).cast(pa.int32()), pa.array([len(p) for p in made], type=pa.int64()),
                                   pa.array([p.tobytes() for p in made], type=pa.binary())], names=["doc_id", "quality", "n", "passages"])

    kept = write_table(rows.mapInArrow(run, "doc_id long, quality int, n long, passages binary")
                       .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "passages").limit(max_train)
                       .withColumn("row", F.monotonically_increasing_id()), "training-rows")
    fits, room = [], max_passages
    for row, n in sorted(kept.select("row", "n").collect()):  # at most max_train rows
        if n <= room:
            fits.append(row)
            room -= n
    # at most max_passages short vectors
    found = sorted((r["doc_id"], r["quality"], bytes(r["passages"])) for r in
                   kept.filter(F.col("row").isin(fits)).select("doc_id", "quality", "passages").collect())
    return fit([np.frombuffer(p, dtype=np.float32).reshape(-1, WIDTH) for _, _, p in found], [q for _, q, _ in found])


def _scores(model: Model, column: list[str]):
    import numpy as np
    out = []
    for at in range(0, len(column), 500):
        bags = [encoder().passages(t or "") for t in column[at:at + 500]]
        out.append(model.scores(bags))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(_scores(model, batch.column(1).to_pylist()), type=pa.float64())],
                                  names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Pipeline stage: rows scored at least ``threshold``, with all their columns."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            good = _scores(model, batch.column(batch.schema.get_field_index("text")).to_pylist()) >= threshold
            yield batch.filter(pa.array(good, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                                   (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
