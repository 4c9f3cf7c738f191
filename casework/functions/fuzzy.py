"""Near-match scoring for the last categorisation tier.

Small helpers used inside an Arrow ``pandas_udf`` over *distinct* unmatched
texts only.  Scores follow the public definition of the weighted ratio:
``ratio`` is the normalised Indel similarity 200*LCS/(len1+len2);
with r = longer/shorter length, r < 1.5 gives max(ratio, 0.95*token_ratio),
otherwise scale = 0.9 (r <= 8) or 0.6 and the score is
max(ratio, scale*partial_ratio, 0.95*scale*partial_token_ratio).

``best_matches`` scores a batch against all labels.  A bound from lengths,
character counts and shared words (``weighted_bound``) leaves out every pair
that can't reach the accepted score; all LCS lengths that the other pairs need
are then found together, one bit-parallel step a character over all of them.
A scorer is a ``Scorer``: its name with version, its score and its bound.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass


def _lcs(a: str, b: str) -> int:
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    return 200.0 * _lcs(a, b) / total


Ratio = Callable[[str, str], float]


def partial_ratio(a: str, b: str, ratio: Ratio = ratio) -> float:
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    best = 0.0
    chars = set(a)
    windows = [b[i:i + m] for i in range(n - m + 1)]
    windows += [b[:k] for k in range(1, m)] + [b[n - k:] for k in range(1, m)]
    for w in windows:
        if w[0] not in chars and w[-1] not in chars:
            continue
        best = max(best, ratio(a, w))
        if best == 100.0:
            break
    return best


def _sorted_tokens(tokens) -> str:
    return " ".join(sorted(tokens))


def token_sort_ratio(a: str, b: str, ratio: Ratio = ratio) -> float:
    return ratio(_sorted_tokens(a.split()), _sorted_tokens(b.split()))


def token_set_ratio(a: str, b: str, ratio: Ratio = ratio) -> float:
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    inter = ta & tb
    dab, dba = ta - tb, tb - ta
    if inter and (not dab or not dba):
        return 100.0
    sect = _sorted_tokens(inter)
    ab = _sorted_tokens(dab)
    ba = _sorted_tokens(dba)
    sect_ab = f"{sect} {ab}" if sect else ab
    sect_ba = f"{sect} {ba}" if sect else ba
    best = ratio(sect_ab, sect_ba)
    if sect:
        best = max(best, ratio(sect, sect_ab), ratio(sect, sect_ba))
    return best


def partial_token_ratio(a: str, b: str, ratio: Ratio = ratio) -> float:
    la, lb = a.split(), b.split()
    ta, tb = set(la), set(lb)
    if ta & tb:
        return 100.0
    dab, dba = ta - tb, tb - ta
    best = partial_ratio(_sorted_tokens(la), _sorted_tokens(lb), ratio)
    if len(la) == len(dab) and len(lb) == len(dba):
        return best
    return max(best, partial_ratio(_sorted_tokens(dab), _sorted_tokens(dba), ratio))


def weighted_ratio(a: str, b: str, ratio: Ratio = ratio) -> float:
    if not a or not b:
        return 0.0
    l1, l2 = len(a), len(b)
    r = max(l1, l2) / min(l1, l2)
    score = ratio(a, b)
    if r < 1.5:
        return max(score, 0.95 * max(token_sort_ratio(a, b, ratio), token_set_ratio(a, b, ratio)))
    scale = 0.9 if r <= 8.0 else 0.6
    score = max(score, partial_ratio(a, b, ratio) * scale)
    return max(score, partial_token_ratio(a, b, ratio) * 0.95 * scale)


def weighted_bound(a: str, b: str) -> float:
    """At least ``weighted_ratio(a, b)``.  No LCS is longer than the characters
    in common, c.  Whole texts then reach 200c/(len1+len2); the best window of
    the longer text has, in the shorter's m characters, c of c: 200c/(m+c).
    Sorting words keeps the characters (blanks apart, of which there are no
    more); a shared or repeated word may give all, 100."""
    if not a or not b:
        return 0.0
    la, lb = a.split(), b.split()
    ta, tb = set(la), set(lb)
    l1, l2 = sum(map(len, la)), sum(map(len, lb))  # without blanks
    common = (Counter("".join(la)) & Counter("".join(lb))).total() + min(len(a) - l1, len(b) - l2)
    least = l1 + l2 + max(0, len(la) - 1) + max(0, len(lb) - 1)  # blanks single
    whole = min(100.0, 200.0 * common / least) if least else 100.0
    free = bool(ta & tb) or len(ta) < len(la) or len(tb) < len(lb)
    r = max(len(a), len(b)) / min(len(a), len(b))
    if r < 1.5:
        return max(whole, 95.0 if free else 0.95 * whole)
    scale = 0.9 if r <= 8.0 else 0.6
    shorter = min(l1 + max(0, len(la) - 1), l2 + max(0, len(lb) - 1))
    part = min(100.0, 200.0 * common / (shorter + common)) if shorter + common else 100.0
    return max(whole, scale * part, 0.95 * scale * (100.0 if free else part))


def lcs_many(pairs: list[tuple[str, str]]) -> list[int]:
    """LCS length of every pair: one bit-parallel step a character over all
    pairs whose shorter text fits into 64 bits, the others one by one."""
    import numpy as np
    out, fits = [0] * len(pairs), []
    for i, (a, b) in enumerate(pairs):
        if len(a) > len(b):
            a, b = b, a
        if len(a) > 64:
            out[i] = _lcs(a, b)
        elif a:
            fits.append((len(b), i, a, b))
    fits.sort(key=lambda f: -f[0])  # longest first: those still running are the first few
    for at in range(0, len(fits), 20_000):
        part = fits[at:at + 20_000]
        short = {a: k for k, a in enumerate(dict.fromkeys(f[2] for f in part))}  # windows share the shorter text
        codes = np.frombuffer("".join(short).encode("utf-32-le"), dtype="<u4")
        sizes = np.array([len(a) for a in short])
        rows = np.repeat(np.arange(len(short)), sizes)
        places = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        signs, sign = np.unique(codes, return_inverse=True)
        masks = np.zeros((len(short), len(signs) + 1), dtype=np.uint64)  # the last column: signs of no shorter text
        np.bitwise_or.at(masks, (rows, sign), np.uint64(1) << places.astype(np.uint64))
        codes = np.frombuffer("".join(f[3] for f in part).encode("utf-32-le"), dtype="<u4")
        lengths = np.array([f[0] for f in part])
        found = np.searchsorted(signs, codes)
        found[(found == len(signs)) | (signs[np.minimum(found, len(signs) - 1)] != codes)] = len(signs)
        text = np.full((int(lengths[0]), len(part)), len(signs))
        text[np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths), np.repeat(np.arange(len(part)), lengths)] = found
        row = np.array([short[f[2]] for f in part])
        size = sizes[row]
        full = (~np.uint64(0)) >> (64 - size).astype(np.uint64)
        v = full.copy()
        for step in range(int(lengths[0])):
            n = int(np.searchsorted(-lengths, -step, side="left"))
            u = v[:n] & masks[row[:n], text[step, :n]]
            v[:n] = ((v[:n] + u) | (v[:n] - u)) & full[:n]
        for f, m in zip(part, (size - np.bitwise_count(v)).tolist()):
            out[f[1]] = m
    return out


@dataclass(frozen=True)
class Scorer:
    """``score(a, b, ratio)`` takes all its LCS through ``ratio``, and asks for
    the same pairs or more if that gives 0; ``bound(a, b)`` is never below it."""
    name: str
    score: Callable[[str, str, Ratio], float]
    bound: Callable[[str, str], float]


SCORERS = {s.name: s for s in (Scorer("weighted/1", weighted_ratio, weighted_bound),
                               Scorer("indel/1", lambda a, b, ratio: ratio(a, b) if a and b else 0.0, weighted_bound))}
DEFAULT_SCORER = "weighted/1"


def best_matches(texts: list[str], labels: list[str], accept: float, scorer: Scorer) -> list[tuple[int, float]]:
    """(index, score) of the best label of each text, the first one on ties;
    (-1, 0.0) if none reaches ``accept``."""
    near = [(i, k) for i, t in enumerate(texts) for k, lab in enumerate(labels) if scorer.bound(t, lab) >= accept]
    asked: dict[tuple[str, str], int] = {}

    def note(a: str, b: str) -> float:
        asked.setdefault((a, b), len(asked))
        return 0.0

    for i, k in near:
        scorer.score(texts[i], labels[k], note)
    found = lcs_many(list(asked))

    def known(a: str, b: str) -> float:
        return 200.0 * found[asked[a, b]] / (len(a) + len(b)) if a or b else 100.0

    best = [(-1, 0.0)] * len(texts)
    for i, k in near:
        score = scorer.score(texts[i], labels[k], known)
        if score >= accept and score > best[i][1]:
            best[i] = (k, score)
    return best


def best_match(text: str, labels: list[str]) -> tuple[int, float]:
    """Index and score of the best label; the first label wins ties."""
    best_i, best_s = -1, -1.0
    for i, lab in enumerate(labels):
        s = weighted_ratio(text, lab)
        if s > best_s:
            best_i, best_s = i, s
    return best_i, best_s


def clean_label(s: str) -> str:
    """Python mirror of the outcome-text normaliser, for the fixed labels."""
    s = unicodedata.normalize("NFD", s.lower())
    s = "".join(ch for ch in s if unicodedata.category(ch) != "Mn")
    s = s.replace("_", " ").replace("-", " ")
    s = re.sub(r"[^a-z0-9\s]", " ", s)
    return re.sub(r"\s+", " ", s).strip()
