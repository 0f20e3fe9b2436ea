"""Periodic runs in texts: seed-and-extend diagonals.

A run of period q overlaps itself, shifted by q, on at least ``overlap(q)`` words.
Periods are taken in classes [lo, 2 * lo); a class's seeds are k-grams, k being
the least overlap that the class guarantees, so each run of the class holds a
k-gram at two places q apart.  As k is no shorter than the periods of its class,
two occurrences of such a gram in a run lie q apart at least (else the run had a
shorter period), hence neighbours in the gram's list of occurrences are the only
pairs to look at: their number grows with the text, not with its square.  A pair
is extended along its lag's diagonal, in both directions, as far as words match;
a table of the furthest word covered on each lag keeps later pairs of the same
stretch from being extended again.

Grams are named by doubling (a gram of 2m words is a pair of grams of m words),
so equality is exact; what occurs once is left out from then on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.rowwise import judge_texts

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def overlap(period: int, least: int, exponent: int) -> int:
    """Words on which a run of this period must overlap itself, shifted by the period."""
    return max(least - period, (exponent - 1) * period)


def classes(longest: int, least: int, exponent: int) -> list[tuple[int, int]]:
    """Length of the seeds and smallest period of each class, shortest seeds first."""
    found, lo = [], 1
    while exponent * lo <= longest:
        found.append((min(overlap(q, least, exponent) for q in range(lo, min(2 * lo, lo + least + 1))), lo))
        lo *= 2
    return sorted(found)


def _double(level: np.ndarray, m: int) -> np.ndarray:
    """Numbers of grams of 2m words from those of m words; -1 where a gram occurs once."""
    at = np.flatnonzero(level[: len(level) - m] >= 0) if len(level) > m else np.empty(0, np.int64)
    at = at[level[at + m] >= 0]
    out = np.full(len(level), -1, np.int64)
    if len(at):
        _, names, counts = np.unique(level[at] * (level.max() + 1) + level[at + m], return_inverse=True, return_counts=True)
        again = counts[names] > 1
        out[at[again]] = names[again]
    return out


def _seeds(level: np.ndarray, m: int, k: int, lo: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lags of neighbouring occurrences of k-grams (m < k <= 2m) whose lag is in the class, by lag and begin."""
    step = k - m
    at = np.flatnonzero(level[: len(level) - step] >= 0) if len(level) > step else np.empty(0, np.int64)
    at = at[level[at + step] >= 0]
    if not len(at):
        return at, at
    grams = level[at] * (level.max() + 1) + level[at + step]
    order = np.argsort(grams, kind="stable")
    at, same = at[order], np.diff(grams[order]) == 0
    begins, lags = at[:-1], np.diff(at)
    chosen = same & (lags >= lo) & (lags < 2 * lo)
    begins, lags = begins[chosen], lags[chosen]
    order = np.lexsort((begins, lags))
    return begins[order], lags[order]


def _matching(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """The first place from ``at`` on, going by ``step`` (1 or -1), whose word differs from that a lag later."""
    width = 32
    while True:
        if step > 0:
            a, b = ids[at : at + width], ids[at + lag : at + lag + width]
            differ = np.flatnonzero(a[: len(b)] != b)
            if len(differ):
                return at + int(differ[0])
            at += len(b)
            if len(b) < width:
                return at
        else:
            low = max(0, at - width + 1)
            differ = np.flatnonzero(ids[low : at + 1] != ids[low + lag : at + 1 + lag])
            if len(differ):
                return low + int(differ[-1])
            at = low - 1
            if at < 0:
                return -1
        width = min(2 * width, 1 << 16)


def find(words: np.ndarray, counts: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    words: a number for each word, texts one after the other; counts: words of each text.
    """
    text = np.repeat(np.arange(len(counts)), counts)
    if not len(words):
        return np.empty((0, 4), np.int64)
    # Numbers that are a text's own, so nothing matches across texts.
    _, ids = np.unique(text * (int(words.max()) + 1) + words, return_inverse=True)
    level, m = np.where(np.bincount(ids)[ids] > 1, ids, -1), 1
    found: list[tuple[int, int, int]] = []
    for k, lo in classes(int(counts.max()), least, exponent):
        while 2 * m < k:
            level, m = _double(level, m), 2 * m
        if not (level >= 0).any():
            break
        begins, lags = _seeds(level, m, k, lo)
        covered: dict[int, int] = {}
        # The first of seeds that follow each other on a diagonal stands for them.
        new = np.ones(len(begins), bool)
        new[1:] = (np.diff(lags) != 0) | (np.diff(begins) != 1)
        for begin, lag in zip(begins[new].tolist(), lags[new].tolist(), strict=True):
            if begin < covered.get(lag, 0):
                continue
            end = _matching(ids, begin, lag, 1)
            first = _matching(ids, begin, lag, -1) + 1
            covered[lag] = end
            if end - first >= overlap(lag, least, exponent):
                found.append((first, end - first + lag, lag))
    runs = np.array(found, np.int64).reshape(-1, 3)
    owner = text[runs[:, 0]]
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    runs = np.column_stack((owner, runs[:, 0] - begin[owner], runs[:, 1:]))
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def judge(texts: list[bytes | None], least: int, exponent: int) -> list[pa.Array]:
    """Words, runs and collapsed text of each text."""
    split = [(t or b"").split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    flat = np.array([w for words in split for w in words], object)
    runs = find(pd.factorize(flat)[0].astype(np.int64), counts, least, exponent)
    edges = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    collapsed: list[bytes | None] = []
    for i, words in enumerate(split):
        if texts[i] is None:
            collapsed.append(None)
            continue
        if edges[i + 1] > edges[i]:
            change = np.zeros(len(words) + 1, np.int64)
            some = runs[edges[i] : edges[i + 1]]
            np.add.at(change, some[:, 1] + some[:, 3], 1)
            np.add.at(change, some[:, 1] + some[:, 2], -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        collapsed.append(b" ".join(words))
    spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
    return [pa.array(counts), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), spans), pa.array(collapsed, pa.binary()).cast(pa.string())]


def find_runs(df: DataFrame, text: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """All columns but the text, with ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of anything but ASCII white space.  A run is a maximal stretch of words whose smallest period q
    makes it at least ``max(least, exponent * q)`` words long; ``runs`` lists start (in words), length and period, by start,
    then period.  ``collapsed`` has the words that no run contains after its first q words, joined by single spaces.
    ``exponent`` must be 3 or more, since shorter runs have no seed that tells their period.

    A null text has no words, an empty list and a null collapsed text; an empty or blank one collapses to the empty text.  Very long texts
    take memory in proportion to their words and time up to a logarithmic factor, however often one word recurs.  Repeated rows and ties are
    judged each on its own; an empty table gives none.  Other columns pass through, whatever their names, unless called as a result is.
    """
    if exponent < 3 or least < 2:
        raise ValueError("exponent must be 3 or more, least 2 or more")
    results = T.StructType.fromDDL(f"n_words bigint, runs {RUN}, collapsed string")
    return judge_texts(df, text, results, lambda texts: judge(texts, least, exponent))
