"""Texts of Arrow columns in the BPE round trip and in packing: the library's
ids, each distinct piece looked up once."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from casework.llm import bpe, packing
from casework.llm.common import ChunkEncoder, tokenizer_path

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def awkward(n: int) -> list[str]:
    """Texts of signs below U+0250 alone, and of any."""
    draw = random.Random(9)
    plain = [chr(c) for c in range(0x250) if not 0x1c <= c <= 0x1f] + list("     \n\n\t''") + ["the", " Word", "\n ", " ß, ", "'ll", "'S", "'re", " 's", "12.5"]
    signs = plain + list("\x1c\x1f  　ͅé漢ไσΣ") + ["<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(draw.choice(of) for _ in range(draw.randint(0, 30))) for of in (plain, signs) for _ in range(n)]
    texts += ["".join(t) for k in (3, 4) for t in product(" \n'sé.", repeat=k)]
    return texts + ["", " ", "x" * 5000, " \n" * 300, "Ünïcode, ÉTÉ. été! don't", "a\x1cb\x1f c", *[f"a{chr(c)}B{chr(c)} 9" for c in range(0x250)]]


def lists(columns) -> list[list[int]]:
    return [np.frombuffer(b, "<u4").tolist() for b in columns]


@pytest.mark.parametrize("most", [1, 300, 4_000_000])
def test_byte_level_column_is_the_library(most):
    texts, own = awkward(2500), Tokenizer.from_file(BYTE)
    got = lists(ChunkEncoder(BYTE, True, limit=500).encode_column(pa.array(texts), most=most))
    for text, ids in zip(texts, got, strict=True):
        assert ids == own.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("most", [1, 300, 4_000_000])
def test_round_trip_column_is_the_library(most):
    texts, own = awkward(1500), Tokenizer.from_file(WORD)
    coder, at = bpe.Coder(WORD, limit=500), 0
    for counts, ids, decoded in coder.round_trips(pa.array(texts), most=most):
        for n, written, text in zip(counts.to_pylist(), ids.to_pylist(), decoded.to_pylist(), strict=True):
            want = own.encode(texts[at], add_special_tokens=False).ids
            assert (n, written, text) == (len(want), " ".join(map(str, want)), own.decode(want, skip_special_tokens=False)), texts[at]
            at += 1
    assert at == len(texts)


class Counted(dict):
    """A store that counts what it is asked for."""

    def __init__(self, make):
        self.make, self.asked = make, 0

    def __missing__(self, key):
        return self.make(key)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


TEXTS = ["The cat, the dog. " * 500] * 20


def test_round_trip_looks_each_distinct_piece_up_once():
    coder = bpe.Coder(WORD)
    coder.kept = Counted(coder._chunk)
    want = Tokenizer.from_file(WORD).encode(TEXTS[0], add_special_tokens=False).ids
    (counts, ids, _), = coder.round_trips(pa.array(TEXTS))
    assert counts.to_pylist() == [len(want)] * 20 and set(ids.to_pylist()) == {" ".join(map(str, want))}
    assert 0 < coder.kept.asked <= 8  # 120,000 words and signs


def test_packing_looks_each_distinct_piece_up_once(monkeypatch):
    encoder = ChunkEncoder(BYTE, True)
    encoder.kept = Counted(encoder._chunk)
    want = Tokenizer.from_file(BYTE).encode(TEXTS[0], add_special_tokens=False).ids
    assert lists(encoder.encode_column(pa.array(TEXTS))) == [want] * 20
    assert 0 < encoder.kept.asked <= 10


def test_packing_and_round_trip_of_awkward_rows(spark):
    texts = awkward(60)
    docs = spark.createDataFrame([(None if i % 50 == 0 else i // 2, None if i % 40 == 0 else t) for i, t in enumerate(texts)],
                                 "doc_id long, text string").repartition(3)
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    whole = {}
    for r in sorted(packing.pack(docs, BYTE, group_tokens=900, window=64).collect(), key=lambda r: r["start"]):
        if r["doc_tokens"] <= 64 and r["doc_id"] is not None:
            whole.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4").tolist() if r["length"] == r["doc_tokens"] else None)
    for doc_id, got in whole.items():
        want = [byte.encode(t, add_special_tokens=False).ids + [0] for d, t in rows if d == doc_id]
        assert all(ids is None or ids in want for ids in got)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids"]) for r in bpe.round_trip(docs, WORD).collect()) \
        == sorted((d is None, d or 0, len(ids), " ".join(map(str, ids)))
                  for d, t in rows for ids in [word.encode(t, add_special_tokens=False).ids])
