"""Removal of repeated passages: fixed-block anchors.

A passage of ``size`` words that occurs twice holds, in either place, a whole
block of ``(size + 1) // 2`` words that begins at a multiple of that length.
Round one indexes these non-overlapping blocks and probes the index with every
rolling window of a block's length: a passage can only be repeated where its own
block was met by another place's probe and one of its probes met another place's
block.  Round two extends such hits to whole windows: their sequences, told apart
by 64 bits and more, are counted over all batches, and what repeats is removed.
Overlapping repeated windows join into the maximal exact repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm import corpus
from tickloom.llm.words import Words, windows
from tickloom.session import Scratch


def _probes(words: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of all rolling windows of a block's length, their fingerprints, and whether a block is there."""
    prints = windows(words.prints, block)
    at = np.flatnonzero(words.window_starts(block)[: len(prints)])
    in_text = at - np.repeat(words.first[:-1], words.counts)[at]
    return at, prints[at], in_text % block == 0


def _ask_probes(batch: corpus.Batch, size: int, bits: int) -> pa.Table:
    block = (size + 1) // 2
    _, prints, is_block = _probes(Words(batch.data, batch.lengths), block)
    distinct, which, counts = np.unique(prints, return_inverse=True, return_counts=True)
    blocks = np.bincount(which, weights=is_block, minlength=len(distinct))
    notes = np.minimum(counts, 2) | (np.minimum(blocks, 2).astype(np.int64) << 2)
    return corpus.question_rows(batch.number, distinct, corpus.residues(distinct, bits), notes, bits)


def _meet(keys: list[np.ndarray], notes: list[np.ndarray]) -> list[np.ndarray]:
    """For each probe: 4 if it occurs at two places, plus the blocks that it meets (2: two or more)."""
    blocks = np.concatenate([k[n >= 4] for k, n in zip(keys, notes, strict=True)])
    index = np.unique(blocks)
    if not len(index):
        return [np.zeros(len(k), np.uint8) for k in keys]
    probes, found, places, held = [], [], np.zeros(len(index), np.int32), np.zeros(len(index), np.int32)
    for k, n in zip(keys, notes, strict=True):
        at = np.minimum(np.searchsorted(index, k), len(index) - 1).astype(np.int32)
        hit = index[at] == k
        np.add.at(places, at[hit], n[hit] & 3)
        np.add.at(held, at[hit], n[hit] >> 2)
        probes.append(at)
        found.append(hit)
    told = (np.minimum(held, 2) + 4 * (places >= 2)).astype(np.uint8)
    return [np.where(hit, told[at], 0) for at, hit in zip(probes, found, strict=True)]


def _candidates(words: Words, size: int, told: np.ndarray) -> np.ndarray:
    """Positions of the windows that hits leave open."""
    block = (size + 1) // 2
    at, prints, is_block = _probes(words, block)
    n = len(words.prints)
    met, probed = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    if len(at):
        _, which = np.unique(prints, return_inverse=True)
        said = told[which]
        probed[at + 1] = is_block & (said >= 4)
        met[at + 1] = (said & 3) > is_block
    # A window of 2 * block - 1 words holds the block-long windows at its first ``size - block + 1`` words.
    probed, met = np.cumsum(probed), np.cumsum(met)
    reach = size - block + 1
    starts = np.flatnonzero(words.window_starts(size))
    return starts[(probed[starts + reach] > probed[starts]) & (met[starts + reach] > met[starts])]


def _full_windows(words: Words, size: int, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate positions and the two fingerprints of their windows."""
    at = _candidates(words, size, told)
    if not len(at):
        return at, np.empty(0, np.uint64), np.empty(0, np.uint64)
    return at, windows(words.prints, size)[at], windows(words.prints, size, second=True)[at]


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, places of the distinct pairs in it, and the number of the pair at each place."""
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _ask_windows(batch: corpus.Batch, size: int, bits: int, told: np.ndarray) -> pa.Table:
    _, first, second = _full_windows(Words(batch.data, batch.lengths), size, told)
    order, new, which = _distinct(first, second)
    counts = np.bincount(which, minlength=len(new))
    prints, further = first[order][new], second[order][new]
    return corpus.question_rows(batch.number, prints, corpus.residues(prints, bits, further), np.minimum(counts, 2), bits)


def _count(keys: list[np.ndarray], notes: list[np.ndarray]) -> list[np.ndarray]:
    """1 for windows that occur at two or more places."""
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(which, weights=np.concatenate(notes), minlength=len(distinct))
    return np.split((counts[which] >= 2).astype(np.uint8), np.cumsum([len(k) for k in keys])[:-1])


def _covered(batch: corpus.Batch, words: Words, size: int, told: list[np.ndarray]) -> np.ndarray:
    """For each word: does a repeated window cover it?"""
    at, first, second = _full_windows(words, size, told[0])
    change = np.zeros(len(words.prints) + size + 1, np.int64)
    if len(at):
        order, _, which = _distinct(first, second)
        repeated = at[order][told[1][which] > 0]
        change[repeated] += 1
        change[repeated + size] -= 1
    return np.cumsum(change)[: len(words.prints)] > 0


def remove_repeats(scratch: Scratch, df: DataFrame, text: str = "text", size: int = 35, with_text: bool = True) -> DataFrame:
    """Remove each word that a repeated window of ``size`` words covers.

    Words are runs of anything but ASCII white space, taken unchanged.  Returns all rows with their other
    columns, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by single spaces) and, if asked
    for, that text under its old name.  A null text counts as no words and stays null; an empty or blank one
    becomes empty; texts shorter than a window stay whole, but for the white space.  Repeated rows, whatever
    their keys, are places of their own: of equal long texts nothing stays.  Other columns pass through, whatever their
    names, unless one is called as a result is; then the result replaces it.
    """
    batches = corpus.store(scratch, df, text)
    bits = corpus.range_bits(batches, 1 / 6)
    rest = batches.schema["rest"].dataType.elementType
    results = ["n_words", "n_removed", "kept_sha256"]
    kept_columns = [f for f in rest if f.name not in results and f.name in df.columns]
    schema = T.StructType(
        [*kept_columns, *([T.StructField(text, T.StringType())] if with_text else []), *(T.StructField(n, T.LongType()) for n in results[:2]), T.StructField(results[2], T.StringType())]
    )

    first = scratch.keep(corpus.answer(corpus.ask(batches, lambda b: _ask_probes(b, size, bits)), _meet, np.uint32), "met")
    asked = corpus.with_answers(batches, [first], lambda b, _, told: _ask_windows(b, size, bits, told[0]), corpus.QUESTION)
    second = scratch.keep(corpus.answer(asked, _count, np.uint64), "repeated")

    def finish(batch: corpus.Batch, others: pa.StructArray, told: list[np.ndarray]) -> pa.Table:
        words = Words(batch.data, batch.lengths)
        keep = ~_covered(batch, words, size, told)
        texts, hashes, removed = [], [], []
        for i, n in enumerate(words.counts):
            first_word, last = int(words.first[i]), int(words.first[i + 1])
            flags = keep[first_word:last]
            found = batch.text(i).split() if flags.any() else []
            joined = b" ".join(found if flags.all() else [found[k] for k in np.flatnonzero(flags)])
            texts.append(joined)
            hashes.append(hashlib.sha256(joined).hexdigest())
            removed.append(int(n - flags.sum()))
        columns = [others.field(f.name) for f in kept_columns]
        if with_text:
            columns.append(pa.array(texts, pa.binary(), mask=batch.null).cast(pa.string()))
        columns += [pa.array(words.counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(hashes)]
        return pa.Table.from_arrays(columns, names=schema.names)

    return corpus.with_answers(batches, [first, second], finish, schema)
