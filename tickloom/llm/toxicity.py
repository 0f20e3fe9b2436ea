"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are n-grams of code points, lower-cased (A-Z) with each run of white space as one
space, told apart by 32 bits of a hash; a feature is present or not.  From the labelled training rows each n-gram gets a
log ratio of its smoothed frequencies in toxic and in other texts.  The most telling ones,
by the likelihood-ratio statistic of presence against label, are the classifier's
features, each scaled by its ratio; the weights are a logistic regression's.  They are sought in two
passes: counts by the hash's upper bits first, then by all its bits where those are telling.

The longer a text, the more features it holds by chance.  So a text is scored in segments of
``SEGMENT`` characters, about as long as texts trained on, and its odds are the sum of its segments' odds over
the square root of their number: one segment must stand out the more, the more there are, but not as much more.  Scoring reads every whole text and sees nothing but the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.corpus import release
from tickloom.llm.rowwise import judge_texts
from tickloom.session import Scratch

SIZES = (3, 4, 5, 6)
#: Bits of an n-gram's hash, upper ones that the first pass counts by, and code points of a segment.
KEY_BITS, HASH_BITS = 32, 19
SEGMENT = 16_384
#: Code points whose n-grams are in memory at a time: whole segments.
BLOCK = 8 * SEGMENT
#: Texts of each class that the classifier is trained on at most, and features that it keeps.
TRAINING_ROWS = 12_000
FEATURES = 8192
SMOOTHING = 1.0
PENALTY = 1e-3
#: Half the likelihood-ratio statistic that a feature needs, so that chance makes few.
LEAST_GAIN = 8.0
_PRIMES = tuple(np.uint32(p) for p in (2246822519, 16777619, 2654435761, 3266489917))


@dataclass(frozen=True)
class Grams:
    """Hashes of a text's n-grams, repeats included, the places at which they begin, and the text's length."""

    keys: np.ndarray
    begins: np.ndarray
    length: int


def _letters(text: str) -> np.ndarray:
    """Numbers of a text's characters, A-Z as a-z, white space as one blank each."""
    data = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    data = np.where((data >= 0x41) & (data <= 0x5A), data + np.uint32(32), data)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    data = np.where(space, np.uint32(0x20), data)[~(space & np.concatenate(([False], space[:-1])))]
    letters = (data + np.uint32(1)) * _PRIMES[0]
    return letters ^ (letters >> np.uint32(15))


def _grams(letters: np.ndarray, most: int) -> Grams:
    """N-grams that begin at the first ``most`` letters."""
    rolled, keys, begins = np.zeros(len(letters), np.uint32), [], []
    for n in range(1, max(SIZES) + 1):
        if len(letters) < n:
            break
        rolled = rolled[: len(letters) - n + 1] * _PRIMES[1] + letters[n - 1 :]
        if n in SIZES:
            mixed = rolled[:most]
            mixed = (mixed ^ (mixed >> np.uint32(16)) ^ np.uint32(n * 0x9E3779)) * _PRIMES[2]
            mixed ^= mixed >> np.uint32(15)
            keys.append(mixed * _PRIMES[3])
            begins.append(np.arange(len(mixed)))
    if not keys:
        return Grams(np.empty(0, np.uint32), np.empty(0, np.int64), len(letters))
    return Grams(np.concatenate(keys), np.concatenate(begins), len(letters))


def ngrams(text: str) -> Grams:
    letters = _letters(text)
    return _grams(letters, len(letters))


def _blocks(text: str) -> Iterator[tuple[int, Grams]]:
    """Where each block of segments begins, and the n-grams that begin in it, so that a long text's are never in memory together."""
    letters = _letters(text)
    for at in range(0, len(letters), BLOCK):
        yield at, _grams(letters[at : at + BLOCK + max(SIZES) - 1], BLOCK)


class Keys:
    """Sorted hashes that others are looked up in."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.upper = np.zeros(1 << HASH_BITS, bool)
        self.upper[keys >> np.uint32(KEY_BITS - HASH_BITS)] = True

    def find(self, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Begins of the n-grams that are among the keys, and their numbers there."""
        some = np.flatnonzero(self.upper[grams.keys >> np.uint32(KEY_BITS - HASH_BITS)])
        if not len(some) or not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        wanted = grams.keys[some]
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        same = self.keys[place] == wanted
        return grams.begins[some[same]], place[same]


class Model:
    """Hashes of the features, ascending, their weights, and the intercept."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, intercept: float):
        self.known, self.weights, self.intercept = Keys(keys), weights, intercept

    def log_odds(self, text: str | None) -> float:
        """Log of the summed odds of the text's segments over the root of their number; a feature counts once a segment."""
        size, length, parts = max(1, len(self.weights)), 0, []
        for begin, found in _blocks(text or ""):
            at, which = self.known.find(found)
            parts.append(np.unique(((begin + at) // SEGMENT) * size + which))
            length = begin + min(found.length, BLOCK)
        pairs, segments = np.concatenate(parts), -(-max(1, length) // SEGMENT)
        sums = np.bincount(pairs // size, weights=self.weights[pairs % size], minlength=segments) + self.intercept
        return float(np.logaddexp.reduce(sums) - np.log(segments) / 2)


def _presence(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Distinct upper bits of the hashes of each text."""
    seen = np.zeros(1 << HASH_BITS, bool)
    for text in texts:
        distinct = []
        for _, grams in _blocks(text or ""):
            found = grams.keys >> np.uint32(KEY_BITS - HASH_BITS)
            distinct.append(np.unique(found[~seen[found]]))
            seen[distinct[-1]] = True
        distinct = np.concatenate(distinct)
        seen[distinct] = False
        yield distinct


def _gain(counts: tuple, texts: tuple, term: Callable):
    """Half the likelihood-ratio statistic of presence against label."""
    total, both = counts[0] + counts[1], texts[0] + texts[1]
    seen = [term(counts[k], total * texts[k] / both) for k in (0, 1)]
    unseen = [term(texts[k] - counts[k], (both - total) * texts[k] / both) for k in (0, 1)]
    return seen[0] + seen[1] + unseen[0] + unseen[1]


#: Parts of the table of upper bits; each is summed up in a task of its own.
PARTS = 64


def _telling(training: DataFrame, texts: np.ndarray) -> np.ndarray:
    """Upper bits of the hashes that may hold a feature, at most ``2 * FEATURES``, ascending."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << HASH_BITS), np.int32)
        for part in parts:
            for label, distinct in zip(part.column("label").to_pylist(), _presence(part.column("text").to_pylist()), strict=True):
                counts[label, distinct] += 1
        pieces = [[p.tobytes() for p in np.split(side, PARTS)] for side in counts]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS)), *(pa.array(p, pa.binary()) for p in pieces)], names=["part", "n_0", "n_1"])
        release()

    def term(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    def judge(table: pa.Table) -> pa.Table:
        counts = [np.sum([np.frombuffer(x, np.int32) for x in table.column(c).to_pylist()], axis=0, dtype=np.int64) for c in ("n_0", "n_1")]
        gain = _gain((counts[0], counts[1]), (int(texts[0]), int(texts[1])), term)
        at = np.flatnonzero(gain >= LEAST_GAIN)
        return pa.table({"bits": table.column("part")[0].as_py() * (1 << HASH_BITS) // PARTS + at, "gain": gain[at]})

    counted = training.coalesce(8).mapInArrow(count, "part long, n_0 binary, n_1 binary")
    best = counted.groupBy("part").applyInArrow(judge, "bits long, gain double").orderBy(F.desc("gain"), "bits").limit(2 * FEATURES)
    return np.sort(np.array([r["bits"] for r in best.select("bits").collect()], np.int64))


def _features(training: DataFrame, texts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``FEATURES`` most telling n-grams whose upper bits are chosen, ascending, and their log-count ratios."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.zeros(1 << HASH_BITS, bool)
        upper[chosen] = True
        held: list[list[np.ndarray]] = [[], []]
        for part in parts:
            for label, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist(), strict=True):
                keys = [g.keys[upper[g.keys >> np.uint32(KEY_BITS - HASH_BITS)]] for _, g in _blocks(text or "")]
                held[label].append(np.unique(np.concatenate(keys)))
        counted = [np.unique(np.concatenate(h or [np.empty(0, np.uint32)]), return_counts=True) for h in held]
        keys = np.union1d(counted[0][0], counted[1][0])
        columns = [np.zeros(len(keys), np.int64) for _ in counted]
        for column, (own, n) in zip(columns, counted, strict=True):
            column[np.searchsorted(keys, own)] = n
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), *(pa.array(c) for c in columns)], names=["key", "n_0", "n_1"])
        release()

    found = training.coalesce(8).mapInArrow(run, "key long, n_0 long, n_1 long").groupBy("key").agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))
    sides = (F.col("n_0"), F.col("n_1")), tuple(F.lit(int(n)) for n in texts)
    gain = _gain(*sides, lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0))
    best = found.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "key").limit(FEATURES)
    rows = sorted((r["key"], r["n_0"], r["n_1"]) for r in best.collect())
    keys, n_0, n_1 = np.array(rows, np.int64).reshape(-1, 3).T
    share = [np.log((n + SMOOTHING) / (t + 2 * SMOOTHING)) for n, t in zip((n_0, n_1), texts, strict=True)]
    return keys.astype(np.uint32), share[1] - share[0]


def training_rows(
    scratch: Scratch, df: DataFrame, labels: DataFrame, allowed: Column, key: str, text: str, label: str
) -> tuple[DataFrame, tuple[float, float]]:
    """``label`` and ``text`` of at most about ``TRAINING_ROWS`` allowed rows of each class, chosen by a hash of the key,
    and for each class how many labelled rows one of them stands for.

    Keys without a label of 0 or 1, or with both, take no part.
    """
    keyed = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
    known = keyed.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").where(allowed)
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    steps = 1 << 20
    share = F.lit(0)
    for value, rows in sizes.items():
        share = F.when(F.col("label") == value, min(steps, steps * TRAINING_ROWS // max(rows, 1))).otherwise(share)
    chosen = scratch.keep(known.where(F.pmod(F.xxhash64("key"), F.lit(steps)) < share).select("key", "label"), "labels")
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    thinned = [max(1.0, sizes.get(k, 0) / TRAINING_ROWS) for k in (0, 1)]
    return scratch.keep(texts.join(chosen, "key").select("label", "text"), "training"), (thinned[0], thinned[1])


def train(scratch: Scratch, training: DataFrame, shares: tuple[float, float] | None = None) -> Model:
    """Fit on ``label`` and ``text``; shares: rows thinned to one of class 0 and of class 1.  Without rows of both classes, or a telling feature, all texts score the toxic share."""
    nothing = np.empty(0, np.uint32), np.empty(0)
    rows_of = dict(training.groupBy("label").count().collect())
    texts = np.array([rows_of.get(k, 0) for k in (0, 1)])
    if not texts.all():
        return Model(*nothing, float(np.log((texts[1] + SMOOTHING) / (texts[0] + SMOOTHING))))
    chosen, ratio = _features(training, texts, _telling(training, texts))
    if not len(chosen):
        return Model(*nothing, float(np.log(texts[1] / texts[0])))
    lookup = Keys(chosen)

    def positions(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 64):
                some = part.slice(at, 64)
                rows = [np.unique(np.concatenate([lookup.find(g)[1] for _, g in _blocks(t or "")])).astype(np.int32) for t in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column("label").cast(pa.float64()), pa.array(rows, pa.list_(pa.int32()))], ["label", "at"])
        release()

    # Stored in between, so that each job has one Python worker a task.
    sparse = scratch.keep(training.coalesce(8).mapInArrow(positions, "label double, at array<int>"), "positions")
    size = len(chosen)
    vector = F.udf(lambda at: SparseVector(size, at, ratio[at]), VectorUDT())
    rows = sparse.select("label", vector("at").alias("features"))
    fitted = LogisticRegression(regParam=PENALTY, maxIter=100, standardization=False).fit(rows)
    # Classes thinned apart come back to their shares among all labelled rows.
    thinned = np.log(shares[1] / shares[0]) if shares else 0.0
    return Model(chosen, fitted.coefficients.toArray() * ratio, float(fitted.intercept + thinned))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is at least 0.5) for every row.

    Null and empty texts have no n-grams and score by the intercept.  Texts of any length are read whole, in segments.  Repeated rows and ties
    score alike; an empty table gives none.  Columns of these names are replaced; all others pass through, whatever their names.
    """
    results = T.StructType().add("score", "double").add("predicted", "integer")

    def judge(texts: list[str | None]) -> list[pa.Array]:
        odds = np.array([model.log_odds(t) for t in texts])
        scores = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

    return judge_texts(df, text, results, judge, binary=False, keep_text=True)


def held_out(key: str) -> Column:
    """Is the row kept from training: crc32 of its key as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(scratch: Scratch, df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the labelled rows of ``df`` that aren't held out."""
    return train(scratch, *training_rows(scratch, df, labels, ~held_out("key"), key, text, label))
