"""Each operator against a plain version of it, on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casework.llm import ann, bpe, context_mix, lines, minhash, packing, pii, quality, shards, simhash, token_store
from casework.llm.common import ChunkEncoder, tokenizer_path
from casework.llm.components import components

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def by_id(row):
    return (row["doc_id"] is not None, row["doc_id"] or 0)


def library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def awkward_texts(n, seed=1):
    draw = random.Random(seed)
    signs = list(" \t\n\x0b\r\x1c\x1f\x85\xa0 　aAbBéÉeßσΣİ'sStT<|endoftext|>19.,!#_-+@`漢字ไ́​क़क़") + \
        ["<|endoftext|>", "<|startoftext|>", " the", "'LL", " '", "  ", "word"]
    return ["".join(draw.choice(signs) for _ in range(draw.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path,led", [(WORD, False), (BYTE, True)])
def test_chunk_encoder_is_the_library(path, led):
    texts = awkward_texts(8000) + ["", "a" * 3000, "th " * 900]
    own = library(path)
    encoder = ChunkEncoder(path, led, limit=2000)
    for i in range(0, len(texts), 500):
        for text, ids in zip(texts[i:i + 500], encoder.encode_many(texts[i:i + 500])):
            assert np.frombuffer(ids, "<u4").tolist() == own(text), text


# -- 1 ---------------------------------------------------------------------------------

@pytest.mark.parametrize("ids", [[], [0], [49407], [5, 5, 5], list(range(3000)), [0] * 9000])
def test_range_coder_round_trip(ids):
    assert context_mix.expand(context_mix.compress(np.array(ids))).tolist() == ids


def test_range_coder_round_trip_random():
    draw = np.random.default_rng(0)
    for n in (7, 600, 40_000):
        for ids in (draw.integers(0, 50_000, n), draw.zipf(1.3, n) % 50_000, np.tile(draw.integers(0, 900, 50), n // 50 + 1)[:n]):
            assert (context_mix.expand(context_mix.compress(ids)) == ids).all()
    repeated = np.tile(draw.integers(0, 40_000, 500), 40)
    assert len(context_mix.compress(repeated)) < len(repeated)  # under half of 16 bits an id


def test_blocks_hold_documents_and_notice_damage():
    draw = random.Random(2)
    docs = [(draw.choice([None, i, -i]), np.array([draw.randint(0, 49407) for _ in range(draw.choice([1, 3, 700]))], "<u4").tobytes())
            for i in range(60)]
    for size in (11, 4096, 1 << 20):
        data = b"".join(b + b"\n" for b in token_store.blocks(3, iter(docs), size))
        got = list(token_store.documents_of(data))
        assert [(d, ids) for _, d, _, ids in got] == docs
    broken = bytearray(data)
    broken[len(data) // 2] ^= 1
    with pytest.raises(ValueError):
        list(token_store.documents_of(bytes(broken)))


def test_token_table(docs, none):
    own, at, want = library(WORD), 0, []
    source = sorted(rows_of(docs), key=by_id)
    got = sorted(rows_of(token_store.token_table(docs, WORD)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in source]
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    for r in source:
        ids = np.array(own(r["text"]) + [1], "<u4")
        want.append((by_id(r), len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((by_id(r), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    assert token_store.token_table(none, WORD).count() == 0


# -- 2 ---------------------------------------------------------------------------------

def test_attention_gradient():
    draw = np.random.default_rng(1)
    model = quality.Model()
    x, starts, label = draw.normal(size=(9, quality.WIDTH)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        y = model.forward(x, starts)[0]
        return -(label * np.log(y) + (1 - label) * np.log(1 - y)).mean()

    for name, grad in model.gradient(x, starts, label).items():
        p = model.p[name]
        for at in [tuple(draw.integers(0, s) for s in p.shape) for _ in range(4)]:
            p[at] += 1e-6
            up = loss()
            p[at] -= 2e-6
            down = loss()
            p[at] += 1e-6
            assert abs((up - down) / 2e-6 - grad[at]) < 1e-5


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_table(documents, labels).join(labels, "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all() and got["score"].between(0, 1).all()
    held = got[got["held_out"]]
    good, bad = held[held["quality"] == 1], held[held["quality"] == 0]
    assert (good["predicted"] == 1).mean() > 0.97
    assert (bad["predicted"] == 0).mean() > 0.6


def test_quality_awkward_rows(spark, docs, none):
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (8, 1, 0), (None, 1, 0), (9, None, 0), (13, 0, 0), (14, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.quality_table(docs, labels).count() == docs.count()
    assert set(r["score"] for r in rows_of(quality.quality_table(docs, labels.filter("false")))) == {0.5}
    assert quality.quality_table(none, labels).count() == 0
    kept = quality.keep_good(docs, quality.Model(0.2))
    assert kept.count() == 0 and kept.columns == docs.columns


def test_quality_scores_by_hand(spark):
    """Features, attention and score computed anew, in plain loops."""
    import math
    model = quality.Model(seed=11)
    draw = np.random.default_rng(1)
    model.mean, model.scale = draw.normal(size=quality.WIDTH), draw.uniform(0.5, 2, quality.WIDTH)
    texts = ["", "One two, three!", " ".join(f"Word{i % 40} and The 12 x--, ABC" for i in range(100))]

    def score(text):
        words, seen, bags = text.split(), set(), []
        for at in range(0, len(words), 64):
            rows, new = [], 0
            for w in words[at:at + 64]:
                core = w.strip(quality._MARKS)
                tail = len(w) - len(w.rstrip(quality._MARKS))
                row = [w.isalpha(), tail == 1, tail > 1, len(core) > 1 and core.isupper(), core[:1].isupper(), not core,
                       any(c.isdigit() for c in core), min(len(w), 40) / 10, len(core) < 4, len(core) > 12]
                bucket = zlib.crc32(core.lower().encode()) % 20 if len(core) <= 4 else -1
                rows.append([*map(float, row), *(float(b == bucket) for b in range(20))])
                new += w not in seen
                seen.add(w)
            bags.append([sum(c) / len(rows) for c in zip(*rows)] + [new / len(rows), len(rows) / 64])
        p, hidden, notes = model.p, [], []
        for x in bags or [[0.0] * quality.WIDTH]:
            x = [(a - m) / s for a, m, s in zip(x, model.mean, model.scale)]
            h = [max(0.0, sum(a * w for a, w in zip(x, col)) + b) for col, b in zip(p["w"].T, p["b"])]
            gate = [math.tanh(sum(a * v for a, v in zip(h, vs))) / (1 + math.exp(-sum(a * u for a, u in zip(h, us))))
                    for vs, us in zip(p["v"].T, p["u"].T)]
            hidden.append(h)
            notes.append(math.exp(sum(g * a for g, a in zip(gate, p["a"][:, 0]))))
        z = [sum(n * h[k] for n, h in zip(notes, hidden)) / sum(notes) for k in range(quality.HIDDEN)]
        return 1 / (1 + math.exp(-(sum(a * c for a, c in zip(z, p["c"][:, 0])) + p["d"][0])))

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality.score(frame, model).collect()}
    assert [got[i] for i in range(3)] == pytest.approx([score(t) for t in texts], abs=1e-5)


def test_training_sample_keeps_whole_documents(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(64 * (i % 7 + 1)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    real = quality.fit
    try:
        quality.fit = lambda bags, marks: (seen.append([len(b) for b in bags]), quality.Model(0.5))[1]
        quality.train(docs, labels, max_passages=50)
        quality.train(docs, labels)
    finally:
        quality.fit = real
    taught = [i % 7 + 1 for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    assert sorted(seen[1]) == sorted(taught) and sum(seen[0]) <= 50 and len(seen[0]) > 5


def test_quality_reads_long_words_whole():
    encode = quality.Encoder().passages
    draw = random.Random(8)
    unspaced = "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(5000))
    assert len(encode(unspaced)) == 10 and (encode(unspaced)[:9, -1] == 1).all()
    for changed in (unspaced[:4000] + "7" + unspaced[4001:], unspaced + "!!", unspaced[:4500]):
        assert encode(changed).shape != encode(unspaced).shape or (encode(changed) != encode(unspaced)).any()
    assert encode(unspaced[:512] * 4)[:, -2].tolist() == [1, 0, 0, 0]
    one, two = "a" * 45 + "x", "a" * 45 + "7..."
    assert encode(f"{one} {two}")[0, -2] == 1 and encode(f"{one} {one}")[0, -2] == 0.5
    assert np.allclose(encode(two)[0, :-2], quality.word_features(two))
    assert not any(len(w) > 40 for w in quality.encoder().rows)
    text = " ".join("".join(draw.choices("abcdefg7.", k=draw.randint(1, 40))) for _ in range(500))
    assert len(encode(text)) == 8 and (encode(text)[:7, -1] == 1).all()


def test_quality_of_a_very_long_text_in_turns():
    draw = random.Random(9)
    words = ["".join(draw.choices("abcdef", k=draw.choice([2, 3, 50, 700]))) for _ in range(300)]
    text = " ".join(draw.choices(words, k=2500))
    whole, parts = quality.Encoder().passages(text), quality.Encoder(limit=400).passages(text)
    assert len(whole) > 20 and np.array_equal(whole, parts)
    plain = " ".join(f"w{i % 150}" for i in range(2000))
    assert quality.Encoder(limit=400).passages(plain)[:, -2].sum() * 64 == 150


# -- 3 ---------------------------------------------------------------------------------

def plain_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(items, linked):
    root = {i: i for i in items}
    for i in items:
        for j in items:
            if j < i and linked(i, j):
                a, b = root[i], root[j]
                for k in items:
                    if root[k] in (a, b):
                        root[k] = min(a, b)
    return root


def test_simhash_fingerprints():
    texts = awkward_texts(400) + ["A b C", "A b C d", "a", "", "a b c d e f g " * 40]
    got = simhash.fingerprints_of(texts)
    assert got.tolist() == [plain_simhash(t) for t in texts]


@pytest.mark.parametrize("hot", [4096, 6])
def test_bit_sliced_links_lose_nothing(spark, hot):
    draw = random.Random(4)
    marks = set()
    for _ in range(60):
        seed = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 12])):
            marks.add(seed)
            seed ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 3, 4])))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    table = spark.createDataFrame([(m,) for m in signed], "fp long").repartition(3)
    got = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(table, hot)).collect()}
    want = plain_roots(sorted(signed), lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 3)
    assert {m: got.get(m, m) for m in signed} == want


def test_bit_planes_at_every_move():
    draw = np.random.default_rng(3)
    marks = draw.integers(0, 1 << 63, 300, dtype=np.uint64)
    for i in range(1, 300):
        if i % 3:
            marks[i] = marks[i - 1] ^ np.uint64(sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 6), replace=False)))
    groups = np.zeros(300, dtype=np.int64)
    for radius in (1, 2, 3, 5, 7):
        got = {}
        for i, j in simhash.forest(marks, groups, radius):
            got[i] = j
        want = plain_roots(list(range(300)), lambda a, b: bin(int(marks[a] ^ marks[b])).count("1") <= radius)
        assert {i: got.get(i, i) for i in range(300)} == want


def test_near_duplicates(docs, none):
    source, got = rows_of(docs), rows_of(simhash.near_duplicates(docs))
    marks = {i: plain_simhash(r["text"]) for i, r in enumerate(source)}
    root = plain_roots(list(marks), lambda a, b: bin(marks[a] ^ marks[b]).count("1") <= 3)
    ids = {}
    for i, r in enumerate(source):
        ids.setdefault(root[i], []).append(r["doc_id"])
    want = [(r["doc_id"], f"{marks[i]:016x}", min((d for d in ids[root[i]] if d is not None), default=None)) for i, r in enumerate(source)]
    key = lambda t: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in t)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(want, key=key)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root.values()))
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_components_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(1000, 1001), (5000, 5000)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(401)}, 1000: 1000, 1001: 1000}


# -- 4 ---------------------------------------------------------------------------------

def test_flow_moves_the_fewest_bytes():
    draw = random.Random(5)
    for _ in range(200):
        sizes = [draw.choice([0, draw.randint(0, 50)]) for _ in range(draw.randint(1, 8))]
        capacities = shards.even(sum(sizes), draw.randint(1, 8))
        moves = shards.transfers(sizes, capacities)
        assert all(n > 0 for _, _, n in moves)
        for i, s in enumerate(sizes):
            assert sum(n for a, _, n in moves if a == i) == s
        for j, c in enumerate(capacities):
            assert sum(n for _, b, n in moves if b == j) == c
        staying = sum(n for a, b, n in moves if a == b)
        assert staying == sum(min(s, c) for s, c in zip(sizes, capacities))


def test_sharded_table(spark, docs, none):
    source, got = rows_of(docs), rows_of(shards.sharded_table(docs))
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
                  for r in source)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 0 <= shard < 24
    assert shards.sharded_table(none).count() == 0
    sizes = (shards.sharded_table(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).groupBy("shard").agg(F.sum("size").alias("n"))
             .toPandas()["n"])
    assert len(sizes) == 24 and sizes.max() - sizes.min() < 0.01 * sizes.mean()


def test_only_affected_shards_are_rewritten(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x" * 92, o) for i, o in enumerate([0] * 10 + [1] * 14 + [2] * 6)], "doc_id long, text string, o int")
    moved = shards.reshard(rows, F.col("o"), 3, 3)
    assert moved.filter("__old <> __shard").count() == 4
    assert shards.rewrite(moved, str(tmp_path / "out")) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


# -- 5 ---------------------------------------------------------------------------------

def test_automaton_is_the_library(docs, none):
    from tokenizers import Tokenizer
    t, coder = Tokenizer.from_file(WORD), bpe.Coder(WORD, limit=3000)
    draw = random.Random(6)
    words = ["".join(draw.choice("aabehilnorstthein") for _ in range(draw.randint(1, 60))) for _ in range(1500)]
    for text in awkward_texts(5000, 7) + words + ["a" * 2000, "!" * 700, "th" * 300]:
        ids = t.encode(text, add_special_tokens=False).ids
        assert coder.round_trip(text) == (len(ids), " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)), text
    want = []
    for r in rows_of(docs):
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((by_id(r), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((by_id(r), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(bpe.round_trip_table(docs, WORD))) \
        == sorted(want)
    assert bpe.round_trip_table(none, WORD).count() == 0


def test_automaton_against_plain_merging():
    draw = random.Random(8)
    for _ in range(150):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        while len(merges) < draw.randint(1, 14):
            u, v = draw.choice(list(vocab)), draw.choice(list(vocab))
            if u + v not in vocab:
                vocab[u + v] = len(vocab)
                merges.append((u, v))
        rank = {m: i for i, m in enumerate(merges)}
        machine = bpe.Automaton(vocab, merges)
        for _ in range(40):
            word = "".join(draw.choice("abc") for _ in range(draw.randint(0, 14)))
            parts = list(word)
            while True:
                best = min((rank[p] for p in zip(parts, parts[1:]) if p in rank), default=None)
                if best is None:
                    break
                u, v = merges[best]
                out, i = [], 0
                while i < len(parts):
                    if parts[i:i + 2] == [u, v]:
                        out.append(u + v)
                        i += 2
                    else:
                        out.append(parts[i])
                        i += 1
                parts = out
            assert machine.encode(word) == [vocab[p] for p in parts], (merges, word)


# -- 6 ---------------------------------------------------------------------------------

def plain_lines(source):
    seen, out = set(), {}
    for doc, text in sorted({(by_id(r), r["text"]) for r in source if r["text"] is not None}, key=lambda t: (t[0], xx(t[1]))):
        own = text.split("\n")
        gone = set()
        for p in range(len(own) - 2):
            w = tuple(own[p:p + 3])
            if "".join(w).strip(" "):
                if w in seen:
                    gone |= {p, p + 1, p + 2}
                seen.add(w)
        out[doc, text] = (len(own), len(gone), "\n".join(x for i, x in enumerate(own) if i not in gone))
    return out


def xx(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def test_line_windows(docs, none):
    source = rows_of(docs)
    want = plain_lines(source)
    got = rows_of(lines.dedup_lines(docs))
    assert len(got) == len(source) and set(got[0]) == {*docs.columns, "__n_lines", "__n_removed"}
    expected = sorted(((by_id(r), *want.get((by_id(r), r["text"]), (0, 0, None))) for r in source), key=repr)
    assert sorted(((by_id(r), r["__n_lines"], r["__n_removed"], r["text"]) for r in got), key=repr) == expected
    assert any(r["__n_removed"] for r in got)
    assert lines.line_table(none).count() == 0


def test_line_windows_overlap(spark):
    rows = [(1, "a\nb\na\nb\na\nb"), (2, "q\na\nb\na\nz"), (3, "z\nz\nz\nz"), (4, "b\na\nq")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.line_table(frame).collect()}
    assert got == {1: "a\nb", 2: "q\nz", 3: "z", 4: "b\na\nq"}


# -- 7 ---------------------------------------------------------------------------------

def plain_spans(text):
    out = []
    for kind, pattern in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
                    or kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans():
    draw = random.Random(9)
    signs = list("0123456789011..--  ++()@@ab") + ["4111111111111111", "+1 (974) 555-3436", "a.b@c.d", "10.0.0.12", "é"]
    for _ in range(30_000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 24)))
        assert pii.base_spans(text) == plain_spans(text), text
    for long in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 50_000, "+1" * 50_000):
        pii.base_spans(long)


def test_viterbi_is_the_best_path():
    from itertools import product
    field, draw = pii.Field(), np.random.default_rng(2)
    field.step = draw.normal(size=field.step.shape)
    scores = draw.normal(size=(6, 4, pii.LABELS))
    for s, got in zip(scores, field.viterbi(scores)):
        def value(path):
            ends = [pii.LABELS, *path, pii.LABELS]
            return sum(s[t, k] for t, k in enumerate(path)) + sum(field.step[a, b] for a, b in zip(ends, ends[1:]))
        assert tuple(got) == max(product(range(pii.LABELS), repeat=4), key=value)


def test_field_learns_and_adds():
    field = pii.train()
    runs = pii.labelled_runs()
    assert sum(field.viterbi(field.scores(*t, 0.0)[None])[0].tolist() == k for *t, k in runs) >= 0.97 * len(runs)
    right, found, there = pii.hits(field, pii.HELD_OUT)
    assert right >= 0.9 * found and right >= 0.9 * there
    text = ["ring (017) 555-7713 now", "pages 12 to 40 of 2021, 3.5 each", ""]
    added = pii.added_spans(text, [pii.base_spans(t) for t in text], field)
    assert added == [[(5, 3, 19)], [], []]


def test_numbers_beside_a_pattern_span_are_added():
    field = pii.train()
    text = ["call 415-555-0199 +1 (974) 555-3436 today", "415-555-0199 +1 (974) 555-3436",
            "mail root@intranet ana@mail.example.com kim.99@host now"]
    base = [pii.base_spans(t) for t in text]
    assert base == [[(18, 3, 35)], [(13, 3, 30)], [(19, 0, 39)]]
    added = pii.added_spans(text, base, field)
    assert added == [[(5, 3, 17)], [(0, 3, 12)], [(5, 0, 18), (40, 0, 51)]]
    assert pii.redacted(text[0], base[0] + added[0]) == "call <PHONE> <PHONE> today"
    # one label all over: tokens 1 and 2 lie beside a span within tokens 0, 3 and 4
    assert pii._free([(0, 2), (3, 5), (6, 8), (9, 11), (12, 14), (15, 17)], [0, 9], [2, 13]) == [(3, 8), (15, 17)]


def test_long_and_unspaced_texts_are_read_whole():
    field = pii.train()
    for text, span in (("call 4155550132 or", "4155550132"), ("(555)867-5309 x", "(555)867-5309"), ("a=415-555-0132,", "415-555-0132"),
                       ("ring " + "x" * 70 + ",(017)555-7713 now", "(017)555-7713"), ("漢" * 70 + "415-555-0199漢", "415-555-0199"),
                       ("x" * 3000 + " call 415-555-0199", "415-555-0199")):
        at = text.index(span)
        assert pii.added_spans([text], [pii.base_spans(text)], field) == [[(at, 3, at + len(span))]], text
    assert pii.features("1" * 400) != pii.features("1" * 300 + "." * 3 + "1" * 97)  # no prefix


def test_added_spans_against_all_labellings():
    """Spans of short runs from the best of all label sequences, scored one by one."""
    from itertools import product
    field, draw = pii.train(), random.Random(6)
    parts = ["call", "card", "4155550132", "(017)", "555-7713", "4111111111111111", "root@box", "10.0.0.12", "7", "2021", "12.5", "漢", ",", "x9"]
    for _ in range(150):
        text = draw.choice([" ", ",", "  "]).join(draw.choice(parts) for _ in range(draw.randint(1, 5)))
        base, want = pii.base_spans(text), []
        for before, run, after in pii.marked_runs(text):
            words = [text[a:b] for a, b in run]
            def value(path):
                f = [pii.word_features(before), *map(pii.features, words), pii.word_features(after)]
                out = sum(field.step[a, b] for a, b in zip((pii.LABELS, *path), (*path, pii.LABELS)))
                for t, k in enumerate(path):
                    out += field.bias[k] + field.caution * (k == 0) + sum(field.own[i, k] for i in f[t + 1])
                    out += sum(field.last[i, k] for i in f[t]) + sum(field.next[i, k] for i in f[t + 2])
                return out
            best = max(product(range(pii.LABELS), repeat=len(run)), key=value)
            at = 0
            while at < len(best):  # equal labels together, apart at pattern spans
                to = at
                while to < len(best) and best[to] == best[at]:
                    to += 1
                stretch = []
                for a, b in [*run[at:to], (None, None)]:
                    if a is None or any(s < b and a < e for s, _, e in base):
                        if stretch and best[at]:
                            s, e = stretch[0][0], stretch[-1][1]
                            while s < e and not (text[s].isalnum() or text[s] in "(+"):
                                s += 1
                            while e > s and not (text[e - 1].isalnum() or text[e - 1] == ")" and "(" in text[s:e]):
                                e -= 1
                            want += [(s, best[at] - 1, e)] if s < e else []
                        stretch = []
                    else:
                        stretch.append((a, b))
                at = to
        assert sorted(pii.added_spans([text], [base], field)[0]) == sorted(want), text


def test_find_and_redact(docs, none):
    got = {(by_id(r)): r for r in rows_of(pii.find(docs))}
    row = got[(True, 14)]
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    text = next(r["text"] for r in rows_of(docs) if r["doc_id"] == 14)
    assert row["spans"] == pii.spans_text(plain_spans(text))
    assert row["base_sha256"] == hashlib.sha256(row["spans"].encode()).hexdigest()
    clean = {by_id(r): r for r in rows_of(pii.redact(docs))}
    assert clean[(True, 14)]["text"] == "mail <EMAIL> or <PHONE> from <IP> with <CARD>"
    assert pii.find(none).count() == 0 and pii.redact(none).columns == docs.columns


# -- 8 ---------------------------------------------------------------------------------

def test_best_fit_decreasing():
    draw = random.Random(10)
    for _ in range(300):
        window = draw.choice([1, 2, 5, 16, 17, 1024])
        lengths = [draw.randint(1, 2 * window + 3) for _ in range(draw.randint(0, 60))]
        pieces, n = packing.place(lengths, window)
        rooms = []
        for rest in sorted((x % window for x in lengths if x % window), reverse=True):
            fit = min((r for r in rooms if r >= rest), default=window)
            if fit in rooms:
                rooms.remove(fit)
            rooms.append(fit - rest)
        assert n == sum(x // window for x in lengths) + len(rooms)
        used, covered = {}, {}
        for doc, start, length, sequence, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
            assert used.get(sequence, 0) == offset and offset + length <= window
            used[sequence] = offset + length
        for doc, start, length, _, _ in sorted(pieces):
            assert covered.get(doc, 0) == start
            covered[doc] = start + length
        assert [covered[d] for d in range(len(lengths))] == lengths
        assert sorted(window - u for u in used.values() if u < window) == sorted(r for r in rooms if r)


def test_packed_pieces(docs, none):
    own = library(BYTE)
    got = rows_of(packing.pack(docs, BYTE, group_tokens=3000))
    used, held = {}, {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert used.get(r["sequence_id"], 0) == r["offset"] and r["offset"] + r["length"] <= 1024 and 4 * r["length"] == len(r["ids"])
        used[r["sequence_id"]] = r["offset"] + r["length"]
        held.setdefault((by_id(r), r["doc_tokens"]), []).append((r["start"], r["ids"]))
    want = {}
    for r in rows_of(docs):
        ids = np.array(own(r["text"]) + [0], "<u4").tobytes()
        want.setdefault((by_id(r), len(ids) // 4), []).append(ids)
    assert held.keys() == want.keys()
    for key, pieces in held.items():
        assert b"".join(ids for _, ids in sorted(pieces)) == b"".join(
            ids[at:at + 4 * (n)] for at, n, ids in sorted((4 * s, len(i) // 4, w) for (s, i), w in zip(sorted(pieces), want[key] * len(pieces)))
        ) or len(want[key]) > 1
        assert sum(len(i) for _, i in pieces) == sum(map(len, want[key]))
    assert packing.packed_table(none, BYTE).count() == 0


# -- 9 ---------------------------------------------------------------------------------

def test_nearest_is_exact(spark):
    draw = np.random.default_rng(11)
    points = draw.normal(size=(700, 12)).astype(np.float32)
    points[100:160] = points[50]
    points[200] *= 1000
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(800, None), (900, [0.0] * 12), (1000, [float("nan")] * 12), (1100, [float("inf")] + [0.0] * 11), (1200, [None] + [1.0] * 11),
             (1300, [1.0, 2.0]), (1400, [3.0, 4.0]), (1500, []), (None, points[3].tolist()), (300, points[4].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for r in ann.nearest_table(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    usable = [(i, np.array(v, dtype=float)) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    want = {}
    for q, a in usable:
        if q % 100 == 0:
            far = [(float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in usable if i != q and len(a) == len(b)]
            want.setdefault(q, []).extend(far)
    want.pop(300)  # two rows have this id
    assert got.keys() - {300} == want.keys()
    for q, far in want.items():
        nearest = sorted(far)[:10]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(nearest) + 1))
        assert [i for _, i, _ in mine] == [i for _, i in nearest]
        assert np.allclose([s for _, _, s in mine], [s for s, _ in nearest], rtol=0, atol=1e-12 * max(1, nearest[-1][0]))
    assert ann.nearest_table(frame.filter("false")).count() == 0


# -- 10 --------------------------------------------------------------------------------

def test_minhash_table(docs, none):
    source = sorted(({"doc_id": r["doc_id"], "text": r["text"] or ""} for r in rows_of(docs)), key=lambda r: (by_id(r), xx(r["text"])))
    want = []
    for r, after in zip(source, source[1:] + source[:1]):
        text, n = r["text"], len(r["text"])
        edited = text[:n - n // 4] + after["text"][:n // 4]
        own, new, other = (minhash.signature(t) for t in (text, edited, after["text"]))
        want.append((by_id(r), n, hashlib.sha256(edited.encode()).hexdigest(), minhash.written(own), minhash.written(new),
                     minhash.likeness(own, new), minhash.likeness(own, other)))
    got = rows_of(minhash.fingerprint_table(docs))
    keys = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((by_id(r), *(r[k] for k in keys)) for r in got) == sorted(want)
    assert minhash.fingerprint_table(none).count() == 0
    one = docs.filter("doc_id = 9")
    assert [r["near_next"] for r in rows_of(minhash.fingerprint_table(one))] == [1.0]


def test_minhash_estimates_jaccard():
    draw, off = random.Random(12), []
    for _ in range(60):
        a = [str(draw.randint(0, 9999)) for _ in range(300)]
        b = a[:draw.randint(0, 300)]
        b += [str(draw.randint(0, 9999)) for _ in range(300 - len(b))]
        sets = [{tuple(x[i:i + 5]) for i in range(296)} for x in (a, b)]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        off.append(minhash.likeness(minhash.signature(" ".join(a)), minhash.signature(" ".join(b))) - true)
    assert abs(np.mean(off)) < 0.03 and np.abs(off).max() < 0.25


def test_near_classes(spark, none):
    draw = random.Random(13)
    texts = []
    for _ in range(12):
        base = [str(draw.randint(0, 99999)) for _ in range(200)]
        for _ in range(draw.choice([1, 3, 9])):
            texts.append(" ".join(base))
            base = base[:]
            base[draw.randint(0, 199)] = "new"
    sets = [{tuple(t.split()[i:i + 5]) for i in range(196)} for t in texts]
    want = plain_roots(list(range(len(texts))), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_classes(frame).collect()}
    assert got == want
    assert minhash.near_classes(none).count() == 0
