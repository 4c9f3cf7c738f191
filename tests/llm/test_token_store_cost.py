"""The token store's encoder and coder: what their changes for speed keep."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from casework.llm import context_mix
from casework.llm.common import ChunkEncoder, _ODD, _PUNCTUATION, tokenizer_path

WORD = tokenizer_path("word_bpe_49k.json")


def column_ids(encoder, texts, **most):
    return [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_column(pa.array(texts), **most)]


@pytest.mark.parametrize("most", [1, 300, 4_000_000])
def test_encode_column_is_the_library(most):
    draw = random.Random(5)
    signs = [chr(c) for c in range(0x250)] + list("  \n　 ͅé漢ไ'") + ["<|endoftext|>", "the", "Word", " ß, ", "'LL", "12.5"]
    plain = [s for s in signs if not _ODD.search(s)]
    texts = ["".join(draw.choice(of) for _ in range(draw.randint(0, 30))) for of in (plain, signs) for _ in range(1500)]
    texts += ["", " ", "x" * 5000, "Ünïcode, ÉTÉ. été! don't", "a\x1cb\x1f c", *[f"a{chr(c)}B{chr(c)}9" for c in range(0x250)]]
    own = Tokenizer.from_file(WORD)
    got = column_ids(ChunkEncoder(WORD, False, limit=500), texts, most=most)
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert column_ids(ChunkEncoder(WORD, False), []) == []


def test_column_with_an_offset_and_of_large_strings():
    texts = ["one, two", "", "Three four.", "five's", "six"]
    own = Tokenizer.from_file(WORD)
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, type=kind).slice(1, 3)
        got = [np.frombuffer(b, "<u4").tolist() for b in ChunkEncoder(WORD, False).encode_column(column)]
        assert got == [own.encode(t, add_special_tokens=False).ids for t in texts[1:4]]


def test_each_distinct_piece_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def __missing__(self, key):
            return encoder._chunk(key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    encoder = ChunkEncoder(WORD, False)
    encoder.kept = Counted()
    texts = ["The cat, the dog. " * 500] * 20
    own = Tokenizer.from_file(WORD).encode(texts[0], add_special_tokens=False).ids
    assert column_ids(encoder, texts) == [own] * 20
    assert Counted.asked <= 8  # 100,000 words and signs


def test_arrow_parts_at_the_same_signs():
    from casework.llm.common import _ODD_RE2, _PUNCTUATION_RE2
    import pyarrow.compute as pc
    signs = [chr(c) for c in [*range(0x3000), 0xfffd, 0x1f600, 0x10ffff]]
    assert pc.match_substring_regex(pa.array(signs), _ODD_RE2).to_pylist() == [bool(_ODD.search(s)) for s in signs]
    found = pc.match_substring_regex(pa.array(signs[:0x250]), _PUNCTUATION_RE2).to_pylist()
    assert found == [bool(_PUNCTUATION.search(s)) for s in signs[:0x250]]


@pytest.mark.parametrize("n,crc", [(1, 1103783054), (255, 1330888357), (600, 3222897849), (40000, 2281757428), (300001, 2187734174)])
def test_files_of_before_can_still_be_read(n, crc):
    draw = np.random.default_rng(n)
    ids = draw.zipf(1.3, n) % 50_000
    data = context_mix.compress(ids)
    assert zlib.crc32(data) == crc
    assert (context_mix.expand(data) == ids).all()
