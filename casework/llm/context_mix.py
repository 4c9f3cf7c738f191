"""Adaptive context-mixing range coder for token ids (numpy).

A block of ids is dealt into lanes, each a consecutive run of the block.  All
lanes share one model, are coded in step, and the model learns after each
step, so coder and decoder stay alike.  Three predictions are mixed:

* order 0: adaptive counts of every id;
* order 1: the id last seen after the previous id, with a confidence 0-3;
* order 2: the id last seen after the two previous ids (hashed), likewise.

The mixing weights are the shares of past hits among steps with the same
pair of confidences.  An id's interval is its share of the order-0 range,
widened by the weight of each prediction that names it; every id keeps a
share above zero.  The last ids of orders 1 and 2 are learned after every step,
counts and weights after each of the first ``EARLY`` steps and then every
``EARLY`` steps, when the counts are scaled to a power of two.  The range coder has a 48-bit window, 16-bit digits, and
carries that are added to the digits already written and resolved at the end.
"""

from __future__ import annotations

import numpy as np

TOTAL_BITS = 26
TOTAL = 1 << TOTAL_BITS
WINDOW = 48
MASK = (1 << WINDOW) - 1
LOWEST = 1 << 32
MAX_COUNT = 1 << 21
GAIN = 32
SLOT_BITS = 18
MAX_LANES = 4096
STEPS = 256
SCALE = 22  # bits of the scaled counts; at least one more than those of MAX_COUNT
EARLY = 16
STRETCH = 7  # scaled counts are looked up in stretches of 128


#: Change of a confidence by 4 * (hit or miss) + confidence so far; a miss at 0 or 1 takes the new id instead.
CHANGE = np.array([0, 0, -1, -1, 1, 1, 1, 0], dtype=np.int32)
MARKS = np.arange(128)  # 64 * hit of order 2 + 32 * hit of order 1 + 8 and 2 * confidences of orders 2 and 1 + same id


def _by_mark(hit: int, confidence: int) -> tuple[np.ndarray, np.ndarray]:
    """For every mark: whether a table takes the new id, and the change of its confidence."""
    state = (MARKS // hit & 1) * 4 + (MARKS // confidence & 3)
    return state <= 1, CHANGE[state]


ONE_NEW, ONE_CHANGE = _by_mark(32, 2)
TWO_NEW, TWO_CHANGE = _by_mark(64, 8)


class _Model:
    def __init__(self, alphabet: int):
        self.n = alphabet
        self.counts = np.ones(alphabet, dtype=np.int64)
        self.cum = np.zeros(alphabet + 1, dtype=np.int64)
        self.steps, self.told, self.marks = 0, [], []
        self.one = np.zeros(alphabet, dtype=np.int32)  # 4 * id + confidence
        self.two = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.every, self.stretch = np.arange(alphabet, dtype=np.int32), None
        self.seen = np.full(32, 4, dtype=np.int64)
        self.hits1 = np.ones(32, dtype=np.int64)
        self.hits2 = np.ones(32, dtype=np.int64)
        self._settle()

    def _settle(self) -> None:
        np.cumsum(self.counts, out=self.cum[1:])
        self.total = int(self.cum[-1])
        self.cum <<= SCALE
        self.cum //= self.total  # strictly rising, as the total is at most MAX_COUNT
        self.stretch = None
        free = TOTAL - 2 * MAX_COUNT
        self.weight1 = self.hits1 * free // self.seen
        self.weight2 = self.hits2 * free // self.seen

    def predict(self, last: np.ndarray, before: np.ndarray) -> None:
        self.last = last
        self.slot = ((before * 0x9E3779B1 + last * 0x85EBCA77) >> 7) & ((1 << SLOT_BITS) - 1)
        self.v1, self.v2 = self.one.take(last), self.two.take(self.slot)
        self.p1, self.p2 = self.v1 >> 2, self.v2 >> 2
        self.alike = self.p1 == self.p2
        self.key = (((self.v2 & 3) << 3) + ((self.v1 & 3) << 1) + self.alike).astype(np.intp)
        self.w1, self.w2 = self.weight1.take(self.key), self.weight2.take(self.key)
        self.w0 = TOTAL - self.w1 - self.w2

    def base(self, x: np.ndarray) -> np.ndarray:
        """Order-0 range below id x."""
        return self.cum.take(x) * self.w0 >> SCALE

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.base(x), self.base(x + 1)
        self.same1, self.same2 = self.p1 == x, self.p2 == x
        start = lo + self.w1 * (self.p1 < x) + self.w2 * (self.p2 < x)
        return start, hi - lo + self.w1 * self.same1 + self.w2 * self.same2

    def find(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id whose interval holds t, and that interval."""
        x = self.p2.astype(np.int64)
        start = self.base(x)
        width = self.base(x + 1) - start + self.w2 + self.w1 * self.alike
        start += self.w1 * (self.p1 < self.p2)
        past = t - start
        off = np.flatnonzero((past < 0) | (past >= width))  # not the order-2 prediction
        self.same1, self.same2 = self.alike.copy(), np.ones(len(x), dtype=bool)
        p1, w0, w1 = self.p1.take(off).astype(np.int64), self.w0.take(off), self.w1.take(off)
        skip = self.w2.take(off) * (past.take(off) >= 0)
        rest = t.take(off) - skip
        lo, hi = (self.cum.take(p1 + side) * w0 >> SCALE for side in (0, 1))
        size = hi - lo + w1
        past = rest - lo
        hit = (past >= 0) & (past < size)
        free = np.flatnonzero(~hit)
        w0, skip1 = w0.take(free), (w1 * (past >= 0)).take(free)
        at = (((rest.take(free) - skip1 + 1) << SCALE) - 1) // w0
        if self.stretch is None:  # the last id that begins before or in each stretch of the scaled counts
            self.stretch = np.zeros(1 << (SCALE - STRETCH), dtype=np.int32)
            self.stretch[self.cum[:-1] >> STRETCH] = self.every
            np.maximum.accumulate(self.stretch, out=self.stretch)
        guess = self.stretch.take(at >> STRETCH).astype(np.int64)
        late = np.flatnonzero(self.cum.take(guess) > at)
        guess[late] = np.searchsorted(self.cum, at.take(late), side="right") - 1
        low, high = (self.cum.take(guess + side) * w0 >> SCALE for side in (0, 1))
        p1[free], lo[free], size[free] = guess, low + skip1, high - low
        x[off], start[off], width[off] = p1, lo + skip, size
        self.same1[off], self.same2[off] = hit, False
        return x, start, width

    def learn(self, x: np.ndarray) -> None:
        """After ``interval(x)``, or ``find`` that gave x."""
        mark = self.key + (self.same1.view(np.int8) * np.int16(32) + self.same2.view(np.int8) * np.int16(64))
        own = (x.astype(np.int32) << 2) | 1
        self.one[self.last] = np.where(ONE_NEW.take(mark), own, self.v1 + ONE_CHANGE.take(mark))
        self.two[self.slot] = np.where(TWO_NEW.take(mark), own, self.v2 + TWO_CHANGE.take(mark))
        self.told.append(x)
        self.marks.append(mark)
        self.steps += 1
        if self.steps > EARLY and self.steps % EARLY:
            return
        none, only1, only2, both = np.bincount(np.concatenate(self.marks), minlength=128).reshape(4, 32)
        self.seen += none + only1 + only2 + both
        self.hits1 += only1
        self.hits2 += only2 + both
        self.counts += GAIN * np.bincount(np.concatenate(self.told), minlength=self.n)
        self.told, self.marks = [], []
        while int(self.counts.sum()) > MAX_COUNT:
            self.counts = (self.counts + 1) >> 1
        self._settle()


def _lanes(n: int) -> tuple[int, int, int]:
    """Lanes, steps, and lanes that are alive in the last step."""
    lanes = max(1, min(MAX_LANES, n // STEPS))
    steps = -(-n // lanes)
    return lanes, steps, n - (steps - 1) * lanes


def _parts(ids: np.ndarray, lanes: int, steps: int, alive: int) -> tuple[np.ndarray, np.ndarray]:
    """Views of a block, a lane a row: those alive in the last step, and the others."""
    whole = alive * steps
    return ids[:whole].reshape(alive, steps), ids[whole:].reshape(lanes - alive, steps - 1)


def compress(ids: np.ndarray) -> bytes:
    """One block.  ids: non-negative integers below 2^20."""
    ids = np.asarray(ids).astype(np.uint32, copy=False)
    n = len(ids)
    if not n:
        return b""
    lanes, steps, alive = _lanes(n)
    grid = np.zeros((steps, lanes), dtype=np.uint32)
    longer, shorter = _parts(ids, lanes, steps, alive)
    grid[:, :alive], grid[:-1, alive:] = longer.T, shorter.T
    model = _Model(int(ids.max()) + 1)
    low, rng = np.zeros(lanes, dtype=np.int64), np.full(lanes, MASK + 1, dtype=np.int64)
    room = 2 * steps + 4
    digits = np.zeros(lanes * room, dtype=np.int32)
    first = np.arange(lanes) * room  # a lane's digit 0 is there for the writing only: the code stays below 1
    at = first + 1
    last = before = np.zeros(lanes, dtype=np.int64)
    for step in range(steps):
        k = lanes if step < steps - 1 else alive
        x = grid[step, :k].astype(np.int64)
        model.predict(last[:k], before[:k])
        start, width = model.interval(x)
        r = rng[:k] >> TOTAL_BITS
        l = low[:k] + r * start
        r *= width
        over = np.flatnonzero(l > MASK)
        digits[at[over] - 1] += 1
        l &= MASK
        for _ in range(2):
            short = np.flatnonzero(r < LOWEST)
            if not len(short):
                break
            out = l[short]
            digits[at[short]] = out >> (WINDOW - 16)
            l[short] = (out << 16) & MASK
            r[short] <<= 16
            at[short] += 1
        low[:k], rng[:k] = l, r
        model.learn(x)
        before, last = last[:k], x
    v = (low + (LOWEST - 1)) >> (WINDOW - 16)  # one digit within the range is enough, zeros follow
    digits[at - 1] += (v >> 16).astype(np.int32)
    digits[at] = v & 0xFFFF
    at += 1 - first
    digits = digits.reshape(lanes, room)
    for j in range(int(at.max()) - 1, 0, -1):
        digits[:, j - 1] += digits[:, j] >> 16
        digits[:, j] &= 0xFFFF
    written = np.arange(digits.shape[1])[None, :]
    body = digits[(written >= 1) & (written < at[:, None])].astype("<u2")
    head = np.array([n, model.n], dtype="<u4").tobytes()
    return head + (at - 1).astype("<u4").tobytes() + body.tobytes()


def expand(data: bytes) -> np.ndarray:
    """The ids that ``compress`` was given."""
    if not data:
        return np.zeros(0, dtype=np.int64)
    n, alphabet = (int(v) for v in np.frombuffer(data, dtype="<u4", count=2))
    lanes, steps, alive = _lanes(n)
    lengths = np.frombuffer(data, dtype="<u4", count=lanes, offset=8).astype(np.int64)
    body = np.frombuffer(data, dtype="<u2", offset=8 + 4 * lanes)
    body = np.concatenate([body, np.zeros(1, dtype=body.dtype)])
    ends = np.cumsum(lengths)
    at = ends - lengths

    def take(which: np.ndarray) -> np.ndarray:
        here = at.take(which)
        at[which] = here + 1
        return body.take(np.where(here < ends.take(which), here, len(body) - 1)).astype(np.int64)

    every = np.arange(lanes)
    code = np.zeros(lanes, dtype=np.int64)
    for _ in range(WINDOW // 16):
        code = (code << 16) | take(every)
    rng = np.full(lanes, MASK + 1, dtype=np.int64)
    model = _Model(alphabet)
    grid = np.zeros((steps, lanes), dtype=np.uint32)
    last = before = np.zeros(lanes, dtype=np.int64)
    for step in range(steps):
        k = lanes if step < steps - 1 else alive
        model.predict(last[:k], before[:k])
        r, c = rng[:k] >> TOTAL_BITS, code[:k]
        x, start, width = model.find(np.minimum(c // r, TOTAL - 1))
        c = c - r * start
        r *= width
        for _ in range(2):
            short = np.flatnonzero(r < LOWEST)
            if not len(short):
                break
            c[short] = (c[short] << 16) | take(short)
            r[short] <<= 16
        code[:k], rng[:k] = c, r
        grid[step, :k] = x
        model.learn(x)
        before, last = last[:k], x
    out = np.zeros(n, dtype=np.uint32)
    longer, shorter = _parts(out, lanes, steps, alive)
    longer[:], shorter[:] = grid[:, :alive].T, grid[:-1, alive:].T
    return out.astype(np.int64)
