"""Approximate nearest neighbours on a robust-pruned directed graph per shard.

Vectors join a shard's graph in batches.  Greedy searches from the medoid propose each new vector's
neighbours: the nearest found and those passed on the way.  Pruning keeps the nearest
proposal and drops those that it covers: whose distance to it, times ``relax``, is no larger than
to the vector.  Edges are also made backwards, and pruned anew where a vector has too
many.  A second pass over all vectors relaxes the rule, which leaves longer edges.  A random tree
adds two edges to each vector, so that every vector can be reached.  Beam searches answer queries in each
shard, and the merged best carry exact distances.  How wide the beam must be depends on the
vectors: it is widened until a sample of the queries finds nearly all that a comparison with every vector finds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import vectors
from tickloom.session import Scratch

DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 32, 1.2
#: Vectors of a graph: the more, the smaller the share of them that a search looks at.
SHARD_ROWS = 16384
#: Beams widen until queries of a sample find this share of their truly nearest vectors of the shard.
RECALL, SAMPLE = 0.97, 64
_TOGETHER, _PART = 256, 1 << 17
_FAR = np.float32(3e38)


def _distances(points: np.ndarray, squares: np.ndarray, ids: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Squared distance of each query to its own ids, less the query's own square."""
    return squares[ids] - 2 * np.einsum("bcd,bd->bc", points[ids], query)


def beam_search(points: np.ndarray, squares: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``beam`` nearest found for each query (-1: none) and their distances as in ``_distances``, nearest first; and how many distances that took.

    A wide beam opens several vectors in a step.
    """
    count, n = len(queries), len(points)
    looked, together = count, max(1, beam // 32)
    ids = np.full((count, beam), -1, np.int64)
    near = np.full((count, beam), _FAR, points.dtype)
    open_ = np.zeros((count, beam), bool)
    ids[:, 0], open_[:, 0] = entry, True
    near[:, 0] = _distances(points, squares, ids[:, :1], queries)[:, 0]
    seen = np.zeros((count, n), bool)
    seen[:, entry] = True
    first = np.empty((count, n), np.int32)
    while True:
        active = np.flatnonzero(open_.any(1))
        if not len(active):
            return ids, near, looked
        # Rows are kept nearest first, so the first open places are the nearest open vectors.
        opened = open_[active]
        opened &= opened.cumsum(1) <= together
        at, place = np.nonzero(opened)
        open_[active[at], place] = False
        around = graph[ids[active[at], place]]
        # Distances of new ones alone, once each; what was seen is in the beam or was too far for it.
        row, column = np.nonzero((around >= 0) & ~seen[active[at][:, None], around])
        new, row = around[row, column], at[row]
        first[active[row], new] = np.arange(len(new))
        once = first[active[row], new] == np.arange(len(new))
        new, row = new[once], row[once]
        looked += len(new)
        seen[active[row], new] = True
        many = np.bincount(row, minlength=len(active))
        column = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        found = np.full((len(active), int(many.max(initial=0))), _FAR, points.dtype)
        fresh = np.full(found.shape, -1, np.int64)
        fresh[row, column] = new
        for part in range(0, len(new), _PART):
            s = slice(part, part + _PART)
            found[row[s], column[s]] = squares[new[s]] - 2 * np.einsum("nd,nd->n", points[new[s]], queries[active[row[s]]])
        all_near = np.concatenate([near[active], found], 1)
        order = np.argsort(all_near, 1, kind="stable")[:, :beam]
        near[active] = np.take_along_axis(all_near, order, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], fresh], 1), order, 1)
        open_[active] = np.take_along_axis(np.concatenate([open_[active], fresh >= 0], 1), order, 1)


def robust_prune(points: np.ndarray, squares: np.ndarray, own: np.ndarray, proposals: np.ndarray, relax: float) -> np.ndarray:
    """For each vector of ``own`` at most DEGREE of its proposals (-1: none), diverse by the rule."""
    count, width = proposals.shape
    valid = (proposals >= 0) & (proposals != own[:, None])
    ids = np.where(valid, proposals, 0)
    near = np.where(valid, _distances(points, squares, ids, points[own]) + squares[own][:, None], _FAR)
    order = np.argsort(near, 1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    alive = near < _FAR
    alive[:, 1:] &= (ids[:, 1:] != ids[:, :-1]) | (near[:, 1:] != near[:, :-1])
    between = points[ids]
    gaps = squares[ids][:, :, None] + squares[ids][:, None, :] - 2 * between @ between.transpose(0, 2, 1)
    out = np.full((count, DEGREE), -1, np.int64)
    rows = np.arange(count)
    for k in range(DEGREE):
        some = alive.any(1)
        if not some.any():
            break
        nearest = alive.argmax(1)
        out[some, k] = ids[rows, nearest][some]
        # Distances here are squares, so the factor is too.
        alive &= relax * relax * gaps[rows, nearest] > near
        alive[rows, nearest] = False
    return out


def build_graph(points: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """Neighbours of each vector (-1: none) and the entry."""
    n = len(points)
    squares = np.einsum("nd,nd->n", points, points)
    entry = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    random = np.random.default_rng(seed)
    graph = np.full((n, DEGREE), -1, np.int64)
    some = min(DEGREE // 2, n - 1)
    if some:
        first = random.integers(0, n - 1, (n, some))
        graph[:, :some] = first + (first >= np.arange(n)[:, None])
    for relax in (1.0, RELAX):
        order = random.permutation(n)
        for at in range(0, n, _TOGETHER):
            own = order[at : at + _TOGETHER]
            found, _, _ = beam_search(points, squares, graph, entry, points[own], BUILD_BEAM)
            graph[own] = robust_prune(points, squares, own, np.concatenate([found, graph[own]], 1), relax)
            # Backward edges, by the vector that they start from.
            sources, targets = np.repeat(own, DEGREE), graph[own].ravel()
            sources, targets = sources[targets >= 0], targets[targets >= 0]
            by = np.argsort(targets, kind="stable")
            starts, first_at, many = np.unique(targets[by], return_index=True, return_counts=True)
            back = np.full((len(starts), int(many.max(initial=0))), -1, np.int64)
            column = np.arange(len(by)) - np.repeat(first_at, many)
            back[np.repeat(np.arange(len(starts)), many), column] = sources[by]
            for part in range(0, len(starts), _TOGETHER):
                s = slice(part, part + _TOGETHER)
                width = int(many[s].max(initial=0))
                held, new = graph[starts[s]], back[s, :width]
                both = np.concatenate([held, np.where((new[:, :, None] == held[:, None, :]).any(2), -1, new)], 1)
                full = (both >= 0).sum(1) > DEGREE
                room = starts[s][~full]
                graph[room] = np.take_along_axis(both[~full], np.argsort(both[~full] < 0, 1, kind="stable"), 1)[:, :DEGREE]
                if full.any():
                    graph[starts[s][full]] = robust_prune(points, squares, starts[s][full], both[full], relax)
    return np.concatenate([graph, _tree(n, entry, random)], 1), entry


def _tree(n: int, entry: int, random: np.random.Generator) -> np.ndarray:
    """Two more edges of each vector: a random tree that leads from the entry to every vector, however far apart they lie."""
    order = random.permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    children = np.full((n, 2), -1, np.int64)
    for side in (0, 1):
        child = order[1 + side :: 2]
        children[order[: len(child)], side] = child
    return children


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


class Frame:
    """Where searches of a shard work: vectors moved to their centre and scaled, in single precision if that tells near ones apart."""

    def __init__(self, points: np.ndarray):
        self.scale = np.abs(points).max(initial=0.0) or 1.0
        self.centre = (points / self.scale).mean(0)
        moved = points / self.scale - self.centre
        some = moved[:: max(1, len(moved) // SAMPLE)]
        gaps = [np.partition(((moved - v) ** 2).sum(1), min(1, len(moved) - 1))[min(1, len(moved) - 1)] for v in some]
        noise = np.finfo(np.float32).eps * (moved**2).sum(1).max(initial=0.0)
        self.kind = np.float32 if np.quantile(gaps, 0.05) > 64 * noise else np.float64
        self.points = moved.astype(self.kind)

    def place(self, queries: np.ndarray) -> np.ndarray:
        return (queries / self.scale - self.centre).astype(self.kind)


def measured_beam(points: np.ndarray, frame: Frame, graph: np.ndarray, entry: int, sample: np.ndarray, k: int, beam: int) -> int:
    """The first of beam, 2 * beam, 4 * beam ... with which the sample's queries find RECALL of their k nearest vectors, measured against all of them."""
    squares, moved, n = np.einsum("nd,nd->n", frame.points, frame.points), frame.place(sample), len(points)
    exact = [((points - v) ** 2).sum(1) for v in sample]
    last = [np.partition(e, min(k, n) - 1)[min(k, n) - 1] for e in exact]
    while beam < n:
        found, _, _ = beam_search(frame.points, squares, graph, entry, moved, beam)
        hits = sum(min(k, n, int((e[f[f >= 0]] <= most).sum())) for e, f, most in zip(exact, found, last, strict=True))
        if hits >= RECALL * min(k, n) * len(sample):
            return beam
        beam *= 2
    return min(beam, n)


def build_index(scratch: Scratch, shards: DataFrame) -> DataFrame:
    """Each shard's graph, stored: ``shard``, ``ids``, ``v``, ``node``, ``neighbours``, ``entry``."""
    vector = shards.schema["v"].dataType.simpleString()

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        # Searches work on moved vectors; results are measured on the originals.
        graph, entry = build_graph(Frame(_matrix(shard["v"])).points)
        return pd.DataFrame({"shard": shard["shard"], "ids": shard["ids"], "v": shard["v"], "node": np.arange(len(shard)), "neighbours": list(graph.astype(np.int32)), "entry": entry})

    return scratch.keep(shards.groupBy("shard").applyInPandas(build, f"shard string, ids array<long>, v {vector}, node int, neighbours array<int>, entry int"), "graphs")


def nearest(scratch: Scratch, df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, every: int = 100, beam: int = SEARCH_BEAM) -> DataFrame:
    """For each row whose key is divisible by ``every`` the k nearest rows found by Euclidean distance:
    ``query_id``, ``rank``, ``vec_id``, ``score`` (the distance, in double precision on the original vectors).

    Ties go to the smaller key.  A query's own key is no candidate.  Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do null keys; vectors of other lengths are no candidates.  Repeated rows count once, equal vectors are one
    point of the graph with all keys that can be among the best.  Other columns take no part.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v")).where(vectors.usable("v"))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    index = build_index(scratch, vectors.distinct_vectors(scratch, rows, k, SHARD_ROWS))
    queries, blocks = vectors.query_blocks(scratch, rows, F.col("vec_id") % every == 0)

    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("node", ignore_index=True)
        points, ids = _matrix(shard["v"]), shard["ids"].tolist()
        frame, graph, entry = Frame(points), np.stack(shard["neighbours"].to_numpy()).astype(np.int64), int(shard["entry"].iloc[0])
        squares = np.einsum("nd,nd->n", frame.points, frame.points)
        block = block.sort_values("vec_id", ignore_index=True)
        wanted = _matrix(block["query"])
        # One more than k, as the query itself may be among them.
        wide = measured_beam(points, frame, graph, entry, wanted[:: -(-len(wanted) // SAMPLE)], k + 1, max(beam, 2 * k))
        together = max(1, min(_TOGETHER, _TOGETHER * 512 // wide))
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        for at in range(0, len(block), together):
            part = wanted[at : at + together]
            found, _, _ = beam_search(frame.points, squares, graph, entry, frame.place(part), wide)
            for query, v, near in zip(block["vec_id"].iloc[at : at + together], part, found, strict=True):
                near = near[near >= 0]
                exact = np.sqrt(((points[near] - v) ** 2).sum(1))
                best, scores = vectors.best_ids(query, [ids[i] for i in near], exact, k)
                out["query_id"] += [query] * len(best)
                out["vec_id"] += best
                out["score"] += scores
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return vectors.search_shards(index, queries, blocks, search, "double", False, k)
