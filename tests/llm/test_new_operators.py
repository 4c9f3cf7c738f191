"""Substring dedup, conversation trie and conversation repair against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from casework.llm import ordering, prefix_trie, repair, substrings

CONV = "conv_id long, turn long, role string, text string, d int, block int, kind string, first long"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def xx(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


# -- 11 ----------------------------------------------------------------------------------

def plain_repeats(rows, window):
    seen, out = set(), []
    for doc, text in sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, xx(r[1]), r[1])):
        words, gone = re.findall(r"[^\x20\x09-\x0D]+", text), set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        out.append((doc, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes", [1, 700, 24 << 20])
def test_repeated_windows(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk_bytes)
    draw = random.Random(chunk_bytes)
    vocabulary = ["a", "b", "é", "漢字", "W" * 70, "W" * 70 + "x", "ab", "ba", "\x1f", "\x85"]
    passage = " ".join(draw.choice(vocabulary) for _ in range(30))
    rows = [(draw.choice([None, draw.randint(0, 40)]),
             draw.choice([None, "", " \n", passage, f"{passage}\t{passage}", " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 40)))]))
            for _ in range(160)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, chunk string, at int").repartition(5)
    got = [tuple(r)[:4] for r in substrings.repeat_table(frame, window=5).collect()]
    assert sorted(got, key=repr) == plain_repeats(rows, 5)


def test_repeated_windows_of_awkward_documents(docs, none):
    got = [tuple(r)[:4] for r in substrings.repeat_table(docs).collect()]
    assert sorted(got, key=repr) == plain_repeats([(r["doc_id"], r["text"]) for r in rows_of(docs)], substrings.WINDOW)
    assert any(r[2] for r in got)
    assert substrings.repeat_table(none).count() == 0


def test_spans_are_maximal_and_hold_what_is_removed(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (2, f"x {text} y {text}"), (3, "w0 w1 w2")]
    got = {r["doc_id"]: r for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in got[2]["spans"]] == [(1, 51), (52, 102)] and got[2]["kept"] == "x y"
    assert got[1]["spans"] == got[3]["spans"] == []


def test_sets_round_trip():
    draw = np.random.default_rng(1)
    for n, slots in ((0, 4), (1, 1), (5000, 64), (3, 1 << 16)):
        values = np.unique(draw.integers(0, slots << substrings.LOW, n, dtype=np.uint64))
        data = substrings.pack_set(values, slots)
        assert (substrings.unpack_set(data, len(values)) == values).all()


def test_hashes_that_agree_in_the_first_half_are_told_apart():
    found = substrings.Windows(["a b c a b d"], 2)
    found.one[:], found.two = found.one[0], np.sort(found.two)
    assert found.marked(np.ones(len(found.keys), dtype=bool)).sum() == 4  # a b, b c, c a, b d


# -- 12 ----------------------------------------------------------------------------------

@pytest.mark.parametrize("n,few", [(0, 4), (1, 4), (5000, 40), (5000, 100_000)])
def test_list_ranking(spark, monkeypatch, n, few):
    monkeypatch.setattr(prefix_trie, "FEW", few)
    order = random.Random(n).sample(range(3 * n), n) if n else []
    if n:  # half of it in order of the numbers, half at random
        order[: n // 2] = sorted(order[: n // 2])
    arcs = [(a, b) for a, b in zip(order, [*order[1:], -1])]
    got = {r["id"]: r["rank"] for r in prefix_trie.ranks(spark.createDataFrame(arcs, "id long, succ long")).collect()}
    assert got == {a: i for i, a in enumerate(order)}


def test_running_totals_and_neighbours(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, 1, 2, 3]), i, draw.randint(-5, 5)) for i in range(300)]
    table = ordering.in_order(spark.createDataFrame(rows, "k long, i long, v long"), [ordering.F.col("k"), ordering.F.col("i")], "test")
    got = {r["i"]: r["s"] for r in ordering.running(table, {"s": ordering.F.col("v")}, key="k").collect()}
    place = {r["i"]: r["p"] for r in ordering.numbered(table, "p").collect()}
    after = {r["i"]: r["next_i"] for r in ordering.with_next(table, ["i"]).collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sums: dict = {}
    for n, (k, i, v) in enumerate(rows):
        sums[k] = sums.get(k, 0) + v
        assert got[i] == sums[k] and place[i] == n and after[i] == (rows[n + 1][1] if n + 1 < len(rows) else None)


def plain_trie(rows):
    own: dict = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    nodes: dict = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for key, members in nodes.items():
        under = [k for k in nodes if k[:len(key)] == key]
        leaves = [k for k in under if not any(len(o) == len(k) + 1 and o[:-1] == k for o in nodes)]
        saved = sum((len(nodes[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in under if k)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(key))))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members),
                    sum(len(o) == len(key) + 1 and o[:-1] == key for o in nodes), len(leaves), saved, sha(ends)))
    return sorted(out)


def some_conversations(seed, n=120):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), *range(900, 905), None]:
        for turn in range(draw.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((conv, draw.choice([turn, turn, turn, None, turn + 3]),
                         draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         draw.choice(["hi.", "ok", "ok", "a b!", " \n", "", "x? ", "漢 字。", None]), 1, 2, "x", 3))
    return rows + rows[:40]


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FEW", 50)
    rows = some_conversations(1)
    got = sorted(tuple(r) for r in prefix_trie.trie_table(spark.createDataFrame(rows, CONV).repartition(3)).collect())
    assert got == plain_trie(rows)


def test_trie_of_nothing_and_of_one_turnless_conversation(spark):
    assert prefix_trie.trie_table(spark.createDataFrame([], CONV)).count() == 0
    assert prefix_trie.trie_table(spark.createDataFrame([(None, 1, "user", "a", 1, 1, "", 1)], CONV)).count() == 0
    one = next(c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 == 1 and c % 20)
    rows = prefix_trie.trie_table(spark.createDataFrame([(one, 1, "user", "a", 1, 1, "", 1)], CONV)).collect()
    assert [tuple(r) for r in rows] == [(one, 0, None, 1, 0, 1, 0, sha(str(one)))]


# -- 13 ----------------------------------------------------------------------------------

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
BLANKS = " \t\n\x0b\x0c\r"


def damaged(conv, rows):
    out = []
    for turn, role, text in sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                                   key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(BLANKS)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_by_programming(rows, faults):
    """Cheapest (cost, audit, rows), the least audit among ties, over whole strings."""
    best = {"": (0, "", ())}

    def put(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in STEP:
                        put(best, STEP[state, role[0]], (cost + 5, audit + "I", (*out, (role, ""))))
        return best

    best = insert(best)
    for (_, role, text), fault in zip(rows, faults):
        now: dict = {}
        for state, (cost, audit, out) in best.items():
            put(now, state, (cost + 2, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (state, role[:1]) in STEP:
                    put(now, STEP[state, role[:1]], (cost + more, audit + "K", (*out, (role, text))))
                for new in ("user", "assistant"):
                    if (state, new[0]) in STEP:
                        put(now, STEP[state, new[0]], (cost + 1 + more, audit + "R", (*out, (new, text))))
        best = insert(now)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def best_by_listing(rows, faults):
    """All edit sequences with up to two inserts anywhere, checked by the grammar alone."""
    inserts = [()] + [(i,) for i in "ua"] + [(i, j) for i in "ua" for j in "ua"]
    edits = [[("D", "", 2)] + ([] if f in ("blank", "duplicate") else
                               [("K", r[:1], 5 * (f == "truncated"))] + [("R", n, 1 + 5 * (f == "truncated")) for n in "ua"])
             for (_, r, _), f in zip(rows, faults)]
    found = []
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for chosen in itertools.product(*edits):
            roles, audit, cost = "", "", 0
            for i, gap in enumerate(gaps):
                roles, audit, cost = roles + "".join(gap), audit + "I" * len(gap), cost + 5 * len(gap)
                if i < len(chosen):
                    roles, audit, cost = roles + chosen[i][1], audit + chosen[i][0], cost + chosen[i][2]
            if re.fullmatch("(s?(ua)+)?", roles) and all(r[:1] for (_, r, _), c in zip(rows, chosen) if c[0] == "K"):
                found.append((cost, audit))
    return min(found)


def plain_repair(rows):
    convs: dict = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, own in convs.items():
        now = damaged(conv, own)
        turns, faults = {t for t, _, _ in now if t is not None}, faults_of(now)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(now, now[1:]))
        cost, audit, fixed = best_by_programming(now, faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                     illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in fixed)))
    return out


def test_plain_repair_against_all_edits():
    draw = random.Random(8)
    for _ in range(60):
        rows = [(i, draw.choice(["system", "user", "assistant", "tool"]), draw.choice(["a.", "b", "", "c."])) for i in range(draw.randint(0, 2))]
        faults = faults_of(rows)
        assert best_by_programming(rows, faults)[:2] == best_by_listing(rows, faults)


def test_lattice_audits():
    draw = random.Random(2)
    for _ in range(4000):
        codes = "".join(draw.choice("-suaxSUAX") for _ in range(draw.randint(0, 9)))
        names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}
        rows = [(0, names[c.lower()], "") for c in codes]
        faults = ["blank" if c == "-" else "truncated" if c.isupper() else "" for c in codes]
        price = repair.prices(codes, repair.CLOSE)
        audit, state = repair.trace(codes, price, 0)
        assert (price[0][0], audit + repair.CLOSING[state]) == best_by_programming(rows, faults)[:2]
        if codes:  # the matrix of a block goes with the prices
            m = repair.matrix(codes)
            assert [min(m[4 * q + p] + repair.CLOSE[p] for p in range(4)) for q in range(4)] == price[0]


@pytest.mark.parametrize("block", [512, 3])
def test_repair(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    draw, rows = random.Random(block), some_conversations(3)
    rows += [(2000 + i // 90, i % 90, draw.choice(["system", "user", "assistant", "user", "assistant"]),
              draw.choice([f"a {i}.", f"b {i}", "c!"]), 0, 0, "", 0) for i in range(270)]
    got = {r[0]: tuple(r)[1:] for r in repair.repair_table(spark.createDataFrame(rows, CONV).repartition(3)).collect()}
    assert got == plain_repair(rows)


def test_repair_of_nothing_and_of_dropped_rows(spark):
    assert repair.repair_table(spark.createDataFrame([], CONV)).count() == 0
    gone = next((c, t) for c in range(99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = repair.repair_table(spark.createDataFrame([(*gone, "user", "a.", 0, 0, "", 0)], CONV)).collect()
    assert [tuple(r) for r in rows] == [(gone[0], 0, 0, 0, 0, 0, 0, "", sha(""))]
