"""Rolling fingerprints of bytes, in numpy: anchors of long strings, spans and windows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Seed of the byte tables and multipliers; all executors must agree on it.
SEED = 20240229


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, tuple[int, int, int]]:
    rng = np.random.default_rng(SEED)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(256), draw(256), tuple(int(x) for x in draw(3))


@lru_cache(maxsize=8)
def powers(base: int, size: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """x with its bits stirred, so that its order says nothing about the bytes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def gram_prints(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit fingerprint of each run of `size` bytes, by doubling."""
    table, _, (base, _, _) = tables()
    have, out, total = table[data], None, 0
    step, covered, k = 1, base, size
    while True:
        if k & step:
            # out covers `total` bytes at each place; `have` covers `step` more after them.
            out = have if out is None else out[: len(have) - total] * np.uint64(covered) + have[total:]
            total += step
            if total == size:
                return mixed(out)
        have = have[:-step] * np.uint64(covered) + have[step:] if len(have) > step else have[:0]
        covered = covered * covered % (1 << 64)
        step *= 2


def sliding(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or greatest) of each `width` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return x if have == width else pick(x[: len(x) - (width - have)], x[width - have :])


@dataclass
class Anchors:
    """Anchors of all strings of `length` bytes: the anchor at `at` answers for the starts first..last."""

    print: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Anchors:
    """For texts at data[starts[k]:ends[k]]: each string of `length` bytes in a text has one anchor.

    A string's anchor is the gram in it with the least fingerprint, the first one of equals; so
    equal strings have equal anchors at equal places, whatever stands around them.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return Anchors(none.astype(np.uint64), none, none, none)
    width = length - gram + 1
    v = gram_prints(data, gram)
    least = sliding(v, width)
    # A gram is the least of some string if no string that holds it has a lesser least.
    pad = np.zeros(width - 1, dtype=np.uint64)
    at = np.flatnonzero(v <= sliding(np.concatenate([pad, least, pad]), width, np.maximum))
    own = v[at]
    first, last = at - (width - 1), at.copy()
    for side in (-1, 1):
        open_ = np.arange(len(at))
        step = 1
        while len(open_):
            other = open_ + side * step
            ok = (other >= 0) & (other < len(at))
            open_, other = open_[ok], other[ok]
            ok = np.abs(at[other] - at[open_]) < width
            open_, other = open_[ok], other[ok]
            if side < 0:
                hit = own[other] <= own[open_]
                first[open_[hit]] = np.maximum(first[open_[hit]], at[other[hit]] + 1)
            else:
                hit = own[other] < own[open_]
                last[open_[hit]] = np.minimum(last[open_[hit]], at[other[hit]] - width)
            open_ = open_[~hit]
            step += 1
    text = np.searchsorted(starts, at, side="right") - 1
    first = np.maximum(first, starts[text])
    last = np.minimum(last, ends[text] - length)
    ok = first <= last
    return Anchors(own[ok], at[ok], first[ok], last[ok])


class Spans:
    """128-bit fingerprints of any runs of bytes of one buffer."""

    def __init__(self, data: np.ndarray) -> None:
        one, two, (_, b1, b2) = tables()
        size = 1 << max(10, int(len(data)).bit_length())
        self.sums, self.inverse = [], []
        for table, base in ((one, b1), (two, b2)):
            out = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(table[data] * powers(base, size)[: len(data)], out=out[1:])
            self.sums.append(out)
            self.inverse.append(powers(pow(base, -1, 1 << 64), size))

    def prints(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        salt = np.asarray(salt, dtype=np.uint64) + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return tuple(mixed((s[end] - s[start]) * i[start] + salt * np.uint64(k)).view(np.int64) for s, i, k in zip(self.sums, self.inverse, (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7), strict=True))


#: Bytes that separate words, and lower case for A-Z alone.
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


@dataclass
class Words:
    """Words of several texts in order: a 64-bit print of each, its text, and where it stands in the buffer."""

    print: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, space: np.ndarray = SPACE, lower: bool = True) -> Words:
    """Runs of bytes that aren't space and prints of their (lower-cased) bytes; words never cross texts."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, none)
    inside = ~space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = starts[(starts < ends)]
    begins[edge] = inside[edge]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edge = ends[(starts < ends)] - 1
    stops[edge] = inside[edge]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    prints = Spans(LOWER[data] if lower else data).prints(start, end)[0].view(np.uint64)
    return Words(prints, np.searchsorted(ends, start, side="right"), start, end)


def shingle_prints(words: Words, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Prints of runs of `size` words, and their texts; a shorter text with words is one shingle."""
    w, text = words.print, words.text
    weight = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xE7037ED1A0B428DB], dtype=np.uint64)
    count = np.bincount(text, minlength=n_texts)
    full = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :]) if len(text) >= size else np.zeros(0, dtype=np.int64)
    out = np.zeros(len(full), dtype=np.uint64)
    for k in range(size):
        out += mixed(w[full + k] * weight[k])
    short = np.flatnonzero((count > 0) & (count < size))
    first = np.searchsorted(text, short)
    some = np.zeros(len(short), dtype=np.uint64)
    for k in range(size - 1):
        has = count[short] > k
        some[has] += mixed(w[first[has] + k] * weight[k])
    some += count[short].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    prints, of = np.concatenate([mixed(out), mixed(some)]), np.concatenate([text[full], short])
    order = np.argsort(of, kind="stable")
    return prints[order], of[order]
