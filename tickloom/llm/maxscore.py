"""Exact top-k search by inner product: MaxScore over dimensions as terms.

A query's terms are the dimensions.  With l and u a term's least and largest product in a shard, a
vector's contribution is its product less l, between 0 and the bound u - l.  By bound, terms split
into non-essential ones, which together cannot lift a vector to the threshold (the
k-th best score so far), and essential ones.  What the non-essential ones lack must come from essential terms,
at least one of which then gives as large a part of its own bound; so of the postings, ordered by impact, only the
heads are traversed.  The vectors found are probed term by term, the
largest bounds first, while their score so far plus what the rest could add
is competitive.  Shards are searched apart and their best merged.

Bounds and thresholds are doubles, compared with a slack above their rounding error; scores are summed in whole numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import vectors
from tickloom.session import Scratch

#: Terms probed at a time, and heads of the postings that give the first threshold.
PROBED, SEEDS = 8, 4
#: The largest whole number of 64 bits.
LARGEST = (1 << 63) - 1


class Postings:
    """A shard's vectors with each dimension's postings in order of value."""

    def __init__(self, whole: np.ndarray):
        self.whole = whole.astype(np.int64)
        self.matrix = matrix = whole.astype(np.float64)
        #: Largest size of each dimension's components.
        self.reach = np.abs(matrix).max(0, initial=0.0)
        self.order = np.argsort(matrix, axis=0, kind="stable")
        self.values = np.take_along_axis(matrix, self.order, axis=0)

    def head(self, term: int, weight: float, least: float) -> np.ndarray:
        """Vectors whose product with the weight is at least so much, by the postings."""
        values, order = self.values[:, term], self.order[:, term]
        slack = 1e-9 + 1e-14 * abs(least / weight)
        if weight > 0:
            return order[np.searchsorted(values, least / weight - slack, "left") :]
        return order[: np.searchsorted(values, least / weight + slack, "right")]

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Scores of some vectors as whole numbers, of any size."""
        # Half of what 64 bits hold, as the estimate is in doubles.
        if float(self.reach @ np.abs(query.astype(np.float64))) < 2.0**62:
            return self.whole[at] @ query.astype(np.int64)
        return self.whole[at].astype(object) @ query.astype(object)

    def top(self, whole_query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """All vectors whose score is at least the k-th best (few others may be among them), and their scores."""
        matrix, n = self.matrix, len(self.matrix)
        query = whole_query.astype(np.float64)
        ends = np.stack([self.values[0] * query, self.values[-1] * query])
        low, bound = ends.min(0), np.abs(ends[1] - ends[0])
        base = low.sum()
        terms = np.argsort(-bound, kind="stable")
        terms = terms[bound[terms] > 0]
        if len(terms) == 0 or n <= k:
            return np.arange(n), self.scores(np.arange(n), whole_query)
        # More than sums of as many products can be wrong by in doubles; components of over 53 bits are rounded as well.
        slack = 4 * (len(query) + 8) * np.finfo(np.float64).eps * float(self.reach @ np.abs(query))
        # First threshold: the heads of the largest terms' postings, scored whole.
        seeds = np.unique(np.concatenate([self.order[-2 * k :, t] if query[t] > 0 else self.order[: 2 * k, t] for t in terms[:SEEDS]]))
        threshold = np.sort(matrix[seeds] @ query)[-k] - base - slack if len(seeds) >= k else -np.inf
        # Non-essential: the longest tail of the terms that stays below the threshold.
        tails = np.cumsum(bound[terms][::-1])[::-1]
        essential = int(np.searchsorted(-tails, -threshold, "right")) if threshold > 0 else len(terms)
        essential = min(max(1, essential), len(terms))
        missing = threshold - (tails[essential] if essential < len(terms) else 0.0)
        part = missing / bound[terms[:essential]].sum()
        found = np.zeros(n, bool)
        if part > 0:
            for t in terms[:essential]:
                found[self.head(int(t), float(query[t]), float(low[t] + part * bound[t]))] = True
        else:
            found[:] = True
        alive = np.flatnonzero(found)
        partial = np.zeros(len(alive))
        for at in range(0, len(terms), PROBED):
            some = terms[at : at + PROBED]
            partial += matrix[np.ix_(alive, some)] @ query[some] - low[some].sum()
            rest = tails[at + PROBED] if at + PROBED < len(terms) else 0.0
            if len(alive) > k:
                threshold = max(threshold, np.partition(partial, -k)[-k] - slack)
            keep = partial + rest >= threshold - slack
            alive, partial = alive[keep], partial[keep]
        return alive, self.scores(alive, whole_query)


def top_k(scratch: Scratch, df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """For each row whose key is divisible by ``every`` the k rows of the largest inner product, by components as
    whole numbers floor(scale * x): ``query_id``, ``rank``, ``vec_id``, ``score``.

    Ties go to the smaller key.  A query's own key is no candidate.  Vectors that are null, empty or hold null or
    non-finite components take no part, nor do null keys; vectors of other lengths are no candidates.  Repeated rows count once.  Scores that 64 bits
    don't hold are given as the nearest that they hold, in no stated order among themselves.  Other columns take no part.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("x")).where(vectors.usable("x"))
    whole = rows.select("vec_id", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))
    shards = vectors.distinct_vectors(scratch, whole, k)
    queries, blocks = vectors.query_blocks(scratch, whole, F.col("vec_id") % every == 0)

    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        postings, ids = Postings(np.stack(shard["v"])), shard["ids"].tolist()
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        for query, v in zip(block["vec_id"], block["query"], strict=True):
            # One more, as a vector may be the query's own alone.
            at, scores = postings.top(np.asarray(v, np.int64), k + 1)
            best, negative = vectors.best_ids(query, [ids[i] for i in at], -scores, k)
            out["query_id"] += [query] * len(best)
            out["vec_id"] += best
            out["score"] += [min(max(-s, -LARGEST), LARGEST) for s in negative]
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})

    return vectors.search_shards(shards, queries, blocks, search, "long", True, k)
