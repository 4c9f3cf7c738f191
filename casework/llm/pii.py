"""Personal data (operator 7): fixed patterns, and a linear-chain conditional
random field that adds spans.

Tokens are runs of ASCII letters, digits and the signs of ``_TOKEN``; every
other sign (a comma, a blank, a letter of another script) parts them, and long
tokens are read whole.  A token without a digit or an ``@`` is always "other",
so the chain falls apart at such tokens and only the runs of marked tokens
between them, at most ``GAP`` signs apart, have to be decoded.  A token has
word-shape features of its own, of its neighbours, and of the word beside a
run.  Weights are trained by gradient ascent on the exact log-likelihood
(forward-backward) of the labelled lines below, on the driver, in a few
seconds; how much surer than "other" a label must be (``caution``) is the
value with the best F1 on the held-out lines.  Runs of like length are decoded
together by Viterbi in numpy.  In a run of equal labels, each stretch of
tokens that touch no pattern span becomes a span of that kind.

Defined cases: a null text is empty and has no spans; null and repeated
doc_ids are kept, one result per row; an empty table gives no rows; other
columns are ignored by ``find`` and pass through ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import texts

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # can't start within digits: long ones stay linear
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"[0-9]+")
_TOKEN = re.compile(r"[A-Za-z0-9@._%+()-]+")
GAP = 3  # signs between neighbouring tokens of a run

# The labelled table: [kind text] marks personal data, all other tokens are "other".
LABELLED = """
write to [email ana.lopez34@mail.example.com] today
mail [email info@firma-haus.de] or [email j_doe+news@uni.example.org]
contact: <[email sam7@example.net]> please
answered by [email root@intranet] last night
[email kim.99@host] asked [email lee@desk4], who knew
user=[email joe@box2];role=admin
from:[email ops@server],to:[email dba@node7]
the host [ip 10.0.0.12] did not answer
from [ip 192.168.40.7] to [ip 8.8.4.4] in 30 ms
([ip 172.16.5.250]) was blocked 4 times
ip=[ip 10.1.2.3],port=8080
server [ip 203.0.113.9]: 12 errors
version 4.12.7 was released in 2021
version 10.4.300.12 and build 999.38.82.176 are old
see section 3.2.1.4.5 on page 17
release 1.2.3.4.5.6 of 2019
paid with [card 4111111111111111] at 12:30
card [card 4012 8888 8888 1881] was used twice
charge [card 5500-0000-0000-0004] for 25.00
[card 378282246310005] expires 04/27
card=[card 5105105105105100],exp=11/26
visa [card 4222.2222.2222.2220] ok
order 9807915762804491 was shipped
number 1234567890123456 is a serial number
id 10000000000000 and id 20000000000001
account 7302640918273645 and 6914592418178720 closed
ref 5829174630284756 of 2020
call [phone (017) 555-7713] after 18:00
call [phone +1 (974) 555-3436] or [phone 555-123-4567] today
call [phone 2125550143] or come
call [phone 6465550170] at 9
phone [phone 415-555-0132] and fax [phone 415-555-0199]
phone:[phone 9175550123],room 12
tel [phone 3105550182] before 17:00
tel. [phone (020) 7946-0958] in the morning
tel=[phone 030-555-0147];desk=4
reach us at [phone 030-555-0147] or later
[phone (555) 867-5309] is my number
[phone (212)555-0186] rings twice
ring [phone 212.555.0188] now
ring [phone (310)555-0117] now
a [phone 718-555-0164], then 3 more
b=[phone 303-555-0139],c=5
mobile [phone 07700 900123] or [phone 07700 900456]
fax [phone 555 0100 22] is off
in 2020-2021 there were 12 of 40
chapter 3 verse 16 of 1611
on 2021-03-14 and 14.03.2021 at 10:45
on 2024.05.06 and 06-05-2024, 12 of them
from 1914-1918 to 1939-1945
the sum of 1,250.75 is 30% of 4169
a sum of 2125550 or 6465550 items
room 12-345 on floor 7
lot 555-7713 of 12 boxes
isbn 978-3-16-148410-0 printed in 1999
token 04dbebab91ab85687d33ee was set
key = "254a3ed195c502ef96b5857aa82e5fbc" and 7
key AKIA4Q7RX2 and secret x9Kq20fLm7
a1b2c3 d4e5f6 77x88y 99
sha 9f86d081884c7d659a2feaa0c55ad015
3 of 10 and 7 of 100 and 12 of 1000
45 60 75 90 105 120
@ home @ work @ 5
price @ 30 each
100,000 people in 25 towns
phone 7 of 9 is at desk 12
call 3 of 12 people at 9:30
tel 4 and fax 5 are off
3.5 each and 7.25 or 12.5% of it
in 2020, 2021, and 2022 (see 4) there were 5; 6; and 7
v2 x86 3rd 1990s 20-30 h2o
9:30 10:15 23.59 1/2 3/4
$5 #6 *7 8! 9?
was 1234567890 of 9876543210 bytes
size 4155550 and 2048 and 1048576
the count 8005550199 of rows
under CC BY-NC 4.0. and GPL 3.
a (2) and b (17) of (1999)
"""

# Lines for choosing ``caution`` and for measuring.
HELD_OUT = """
mail [email tom.b4@lab.example.org], then wait 5 days
login [email eva@mainframe] at 7:15
to=[email x1@relay];n=3
the box [ip 10.20.30.40] had 12 errors
src=[ip 198.51.100.23],dst=[ip 10.9.8.7]
version 7.0.1200.4 came in 2018
see 4.5.6.7.8 and 12.13
card [card 6011000990139424] was refused
pay=[card 4000056655665556],cvv=123
[card 3714 496353 98431] was used 2 times
order 4716231508892371 of 2022
serial 8812340056127734 and 12
call [phone 4155550132] or write
[phone (555)867-5309] x
a=[phone 415-555-0132],b=7
phone [phone 808.555.0190] after 9
tel:[phone 5035550111]
ring [phone (017)555-7713] now
fax [phone 030-555-0188] or desk 7
mobile [phone 07700 900789] today
on 2019-11-02 at 08:05 there were 14
from 2001-2009, 30 of 45
lot 231-4477 of 3
the sum 5551234567 of 12 rows
size 1200450 and 64
call 7 of 30 at 10
build 300.12.4.1 of 1998
token 7d33ee04dbebab91 and key 5f2a9c
isbn 978-0-306-40615-7 in 2004
under BSD 3. and 4.0 of (2001)
45, 46, and 47 of 1,250
"""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part, @, host with a dot; linear in the text, however
    long its runs are: each @ is taken with the run before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
            done = host.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns, in order."""
    out = []
    if "@" in text:
        out += [(start, 0, end) for start, end in emails(text)]
    if _MARKED.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- the random field -----------------------------------------------------------------

BUCKETS = 4096
LABELS = len(KINDS) + 1
CAUTIONS = (0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0)  # tried; added to the score of "other" when decoding
KEPT = 30_000  # tokens whose scores are kept


def features(token: str) -> tuple[int, ...]:
    """Buckets of the features of a token that holds a digit or an @."""
    core = token.strip(".%_-")
    shape = re.sub(r"[0-9]", "d", re.sub(r"[A-Za-z]+", "x", core))
    names = [f"shape {shape}", "runs " + re.sub(r"d{5,}", "d", shape), f"digits {min(sum(map(str.isdigit, core)), 20)}",
             "kinds " + "".join(sorted(set(shape)))]
    plain = re.sub(r"[-.]", "", core)
    if plain.isdigit():
        names.append(f"number {min(len(plain), 20)} {12 <= len(plain) <= 19 and luhn(plain)}")
    parts = core.strip("()").split(".")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        names.append(f"quad {all(len(p.lstrip('0')) <= 3 and int(p.lstrip('0') or 0) <= 255 for p in parts)}")
    if "@" in core:
        name, _, host = core.partition("@")
        names.append(f"at {bool(name)} {bool(host)} {'.' in host}")
    return tuple(zlib.crc32(n.encode()) % BUCKETS for n in names)


def word_features(word: str) -> tuple[int, ...]:
    """Buckets of the word beside a run; no word: the text's edge, or far away."""
    return tuple(zlib.crc32(n.encode()) % BUCKETS for n in ("plain", f"word {word.strip('._%+()-').lower()}"))


def marked_runs(text: str) -> list[tuple[str, list[tuple[int, int]], str]]:
    """Runs of neighbouring tokens that hold a digit or an @, as bounds, and
    the words before and after."""
    out, run, word, before, end = [], [], "", "", -GAP - 1
    for m in _TOKEN.finditer(text):
        near = m.start() - end <= GAP
        if _MARKED.search(m[0]):
            if run and not near:
                out.append((before, run, ""))
                run = []
            if not run:
                before = word if near else ""
            run.append(m.span())
            word = ""
        else:
            if run:
                out.append((before, run, m[0] if near else ""))
                run = []
            word = m[0]
        end = m.end()
    if run:
        out.append((before, run, ""))
    return out


class Field:
    """Weights of own, previous and next token's features, and of transitions."""

    def __init__(self):
        import numpy as np
        self.own = np.zeros((BUCKETS, LABELS))
        self.last = np.zeros((BUCKETS, LABELS))
        self.next = np.zeros((BUCKETS, LABELS))
        self.step = np.zeros((LABELS + 1, LABELS + 1))  # the last row and column: outside the run
        self.bias = np.zeros(LABELS)
        self.caution = 0.0
        self.rows: dict[tuple[str, bool], object] = {}

    def __getstate__(self):  # kept scores stay behind
        return {**self.__dict__, "rows": {}}

    def _row(self, token: str, plain: bool):
        import numpy as np
        row = self.rows.get((token, plain))
        if row is None:
            f = list(word_features(token) if plain else features(token))
            row = np.stack([self.own[f].sum(0), self.last[f].sum(0), self.next[f].sum(0)])
            if len(token) <= 40:
                if len(self.rows) >= KEPT:
                    self.rows.clear()
                self.rows[token, plain] = row
        return row

    def scores(self, before: str, run: list[str], after: str, caution: float | None = None):
        """Label scores of each token of a run."""
        import numpy as np
        rows = np.stack([self._row(before, True), *(self._row(t, False) for t in run), self._row(after, True)])
        caution = self.caution if caution is None else caution
        return self.bias + caution * np.eye(LABELS)[0] + rows[1:-1, 0] + rows[:-2, 1] + rows[2:, 2]

    def viterbi(self, batch):
        """Best labels of runs of one length: (runs, length, labels) scores."""
        import numpy as np
        n, length, _ = batch.shape
        inner = self.step[:LABELS, :LABELS]
        best = batch[:, 0] + self.step[LABELS, :LABELS]
        back = np.zeros((n, length, LABELS), dtype=np.int8)
        for t in range(1, length):
            ways = best[:, :, None] + inner[None]
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + batch[:, t]
        best = best + self.step[:LABELS, LABELS]
        out = np.zeros((n, length), dtype=np.int8)
        out[:, -1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        return out


def labelled_lines(table: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, spans) of each line; a span: (start, kind, end)."""
    out = []
    for line in filter(None, table.splitlines()):
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[(\w+) ([^\]]+)\]", line):
            text += line[at:m.start()]
            spans.append((len(text), KINDS.index(m[1]), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        out.append((text + line[at:], spans))
    return out


def labelled_runs(table: str = LABELLED) -> list[tuple[str, list[str], str, list[int]]]:
    out = []
    for text, spans in labelled_lines(table):
        for before, run, after in marked_runs(text):
            labels = [next((k + 1 for a, k, b in spans if a < e and s < b), 0) for s, e in run]
            out.append((before, [text[s:e] for s, e in run], after, labels))
    return out


def hits(field: "Field", table: str, caution: float | None = None) -> tuple[int, int, int]:
    """Spans of the labelled lines found exactly (by pattern or field), found
    in all, and there are."""
    found = right = there = 0
    for text, spans in labelled_lines(table):
        base = base_spans(text)
        got = {*base, *added_spans([text], [base], field, caution)[0]}
        found, there, right = found + len(got), there + len(spans), right + len(got & set(spans))
    return right, found, there


def train(table: str = LABELLED, rounds: int = 60, rate: float = 0.3, decay: float = 0.01) -> Field:
    """Gradient ascent on the log-likelihood of the labelled runs, then the
    choice of the caution."""
    import numpy as np
    field, runs = Field(), labelled_runs(table)

    def logsum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(rounds):
        field.rows.clear()
        g_own, g_last, g_next = (np.zeros_like(field.own) for _ in range(3))
        g_step, g_bias = np.zeros_like(field.step), np.zeros_like(field.bias)
        inner = field.step[:LABELS, :LABELS]
        for before, tokens, after, labels in runs:
            s, n = field.scores(before, tokens, after, 0.0), len(tokens)
            ahead, behind = np.zeros((n, LABELS)), np.zeros((n, LABELS))
            ahead[0] = s[0] + field.step[LABELS, :LABELS]
            for t in range(1, n):
                ahead[t] = s[t] + logsum(ahead[t - 1][:, None] + inner, 0)
            behind[-1] = field.step[:LABELS, LABELS]
            for t in range(n - 2, -1, -1):
                behind[t] = logsum(inner + (s[t + 1] + behind[t + 1])[None], 1)
            whole = logsum(ahead[-1] + behind[-1], 0)
            off = -np.exp(ahead + behind - whole)
            off[np.arange(n), labels] += 1
            g_bias += off.sum(0)
            f = [word_features(before), *map(features, tokens), word_features(after)]
            for t in range(n):
                np.add.at(g_own, list(f[t + 1]), off[t])
                np.add.at(g_last, list(f[t]), off[t])
                np.add.at(g_next, list(f[t + 2]), off[t])
            g_step[LABELS, :LABELS] += off[0]
            g_step[:LABELS, LABELS] += off[-1]
            for t in range(1, n):
                g_step[:LABELS, :LABELS] -= np.exp(ahead[t - 1][:, None] + inner + (s[t] + behind[t])[None] - whole)
                g_step[labels[t - 1], labels[t]] += 1
        for w, g in ((field.own, g_own), (field.last, g_last), (field.next, g_next), (field.step, g_step), (field.bias, g_bias)):
            w += rate * (g - decay * w)
    field.rows.clear()

    def f1(caution: float) -> float:
        right, found, there = hits(field, HELD_OUT, caution)
        return 2 * right / max(1, found + there)

    field.caution = max(CAUTIONS, key=lambda c: (round(f1(c), 6), c))
    return field


def _free(tokens: list[tuple[int, int]], starts: list[int], reach: list[int]) -> list[tuple[int, int]]:
    """Bounds of the stretches of tokens that touch no pattern span, of which
    ``starts`` are the sorted starts and ``reach`` the furthest ends so far."""
    out, apart = [], True
    for a, b in tokens:
        before = bisect_left(starts, b)
        if before and reach[before - 1] > a:
            apart = True
        elif apart:
            out.append((a, b))
            apart = False
        else:
            out[-1] = (out[-1][0], b)
    return out


def added_spans(batch: list[str], base: list[list[tuple[int, int, int]]], field: Field,
                caution: float | None = None) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind, end) the field adds to each text."""
    import numpy as np
    by_length: dict[int, list[tuple[int, tuple[str, list[tuple[int, int]], str]]]] = {}
    for i, text in enumerate(batch):
        if _MARKED.search(text):
            for run in marked_runs(text):
                by_length.setdefault(len(run[1]), []).append((i, run))
    out: list[list[tuple[int, int, int]]] = [[] for _ in batch]
    edges = [([s for s, _, _ in b], list(accumulate((e for _, _, e in b), max))) for b in base]
    for length, runs in by_length.items():
        for at in range(0, len(runs), max(1, 200_000 // length)):
            part = runs[at:at + max(1, 200_000 // length)]
            scores = np.stack([field.scores(before, [batch[i][a:b] for a, b in run], after, caution) for i, (before, run, after) in part])
            for (i, (_, run, _)), labels in zip(part, field.viterbi(scores).tolist()):
                t = 0
                while t < length:
                    u = t
                    while u + 1 < length and labels[u + 1] == labels[t]:
                        u += 1
                    if labels[t]:
                        text = batch[i]
                        for start, end in _free(run[t:u + 1], *edges[i]):
                            while start < end and not (text[start].isalnum() or text[start] in "(+"):
                                start += 1
                            while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")" and "(" in text[start:end]):
                                end -= 1
                            if start < end:
                                out[i].append((start, labels[t] - 1, end))
                    t = u + 1
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per document: doc_id, counts and digest of the pattern spans, and all spans."""
    field = field or train()

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            text = batch.column(1).to_pylist()
            base = [base_spans(t) for t in text]
            added = added_spans(text, base, field)
            counts = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(len(KINDS))]
            yield pa.record_batch([
                batch.column(0), *[pa.array(c, type=pa.int64()) for c in counts],
                pa.array([hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base], type=pa.string()),
                pa.array([spans_text(b + a) for b, a in zip(base, added)], type=pa.string()),
                pa.array(list(map(len, added)), type=pa.int64()),
            ], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return texts(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                       "base_sha256 string, spans string, n_added long")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by its kind."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Pipeline stage: the same columns, personal data in ``text`` replaced."""
    field = field or train()

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            at = batch.schema.get_field_index("text")
            text = batch.column(at).to_pylist()
            whole = [t or "" for t in text]
            base = [base_spans(t) for t in whole]
            added = added_spans(whole, base, field)
            new = [t if t is None or not (b or a) else redacted(t, b + a) for t, b, a in zip(text, base, added)]
            yield pa.RecordBatch.from_arrays([pa.array(new, type=batch.schema.field(at).type) if i == at else c
                                              for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
