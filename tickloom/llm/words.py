"""Words, word windows and their fingerprints over whole batches of text, in numpy.

Texts come as one byte buffer in which a newline separates neighbours.  A word's
fingerprint is a polynomial over its bytes modulo 2**64 (through a random table
per byte), taken from running sums, so the work per byte does not depend on word
or window lengths; windows are the same polynomial over word fingerprints.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE, _WINDOW_BASE, _SECOND_BASE = 0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_SEGMENT = 1 << 18  # bytes or words fingerprinted at a time, which bounds the memory


def _members(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Bytes of words: all but ASCII white space; or ASCII letters and digits and everything beyond ASCII.
NOT_SPACE = ~_members([(0x09, 0x0D), (0x20, 0x20)])
LETTERS = _members([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])


@lru_cache(None)
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        known = np.full(max(n, _SEGMENT // 4) + 1, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all 64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans(data: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of member bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = members[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Fingerprint of each word; lower: A-Z count as a-z."""
    table, out, at = _byte_values(lower), np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _SEGMENT, "right")))
        first, last = int(starts[at]), int(ends[to - 1])
        up, down = _power(_BASE, last - first), _power(_inverse(_BASE), last - first)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(table[data[first:last]] * up[: last - first], out=sums[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        at = to
    return out


def windows(words: np.ndarray, size: int, second: bool = False) -> np.ndarray:
    """Fingerprint of every ``size`` consecutive words; second: an independent one."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = _SECOND_BASE if second else _WINDOW_BASE
    up, down = _power(base, _SEGMENT + size), _power(_inverse(base), _SEGMENT + size)
    out = np.empty(n, np.uint64)
    for at in range(0, n, _SEGMENT):
        part = words[at : min(at + _SEGMENT, n) + size - 1]
        if second:
            part = mix(part + np.uint64(0x9E3779B97F4A7C15))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        k = len(part) - size + 1
        out[at : at + k] = mix((sums[size:] - sums[:k]) * down[:k] + np.uint64(size))
    return out


class Words:
    """The words of several texts: fingerprints, byte spans, and where each text's words begin."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, members: np.ndarray = NOT_SPACE, lower: bool = False):
        """data: the texts with one newline between neighbours; lengths: bytes of each text."""
        self.starts, self.ends = spans(data, members)
        self.prints = fingerprints(data, self.starts, self.ends, lower)
        begins = np.concatenate(([0], np.cumsum(np.asarray(lengths, np.int64) + 1)))
        #: Number of the first word of each text, and of the end.
        self.first = np.searchsorted(self.starts, begins)
        self.counts = np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def window_starts(self, size: int) -> np.ndarray:
        """For each word: do ``size`` words of the same text begin here?"""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.prints))
        return left >= size
