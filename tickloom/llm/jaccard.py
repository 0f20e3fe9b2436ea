"""Exact similarity join of word-shingle sets: light sets by subsets, heavy sets by inverted lists.

Two sets of n and m shingles link if ``100 * common >= percent * union``.

* Equal sets are one node from the start, whatever their number.
* A set none of whose rarest elements, just so many that a linked set must hold one,
  is in another text, links with nothing and is left out.
* Light sets (at most ``boundary`` shingles): the larger part that two linked sets share
  leaves out few elements of either, so each enumerates its subsets of the fixed sizes n, n - 1, ... that
  a link needs.  Linked sets meet in the subset that is their intersection; whether sets
  meeting there link follows from sizes alone, and the smallest set of a meeting links with
  whichever links at all, so a meeting of any number of sets yields a star.
* Heavy sets scan inverted lists: their rarest elements are posted with the set's size and the elements' places,
  but for those that only one text holds.  Lists also hold the sets below the boundary that are within reach of larger ones.
  First each set is paired with its neighbour by size, and the pairs are verified on whole sets.  Lists that then hold
  several components are scanned in whole, in tiles of bounded size that compare all their sets at once.  So copies in
  great numbers cost a few pairs each, and no link between components is lost.

The boundary is where the subsets of the sets below would outnumber the list entries they spare.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import corpus
from tickloom.llm.components import components
from tickloom.llm.words import Words, mix, windows
from tickloom.session import Scratch

#: Larger sets are never enumerated, as their subsets are too many.
LIGHT_MOST = 40
#: Sets in a tile; two meet in a task.
TILE = 500
_KEY_BITS = 48


def _misses(n: int, percent: int) -> int:
    """Elements of a set of n that a linked set may lack."""
    return n - _shared(n, percent)


def _shared(n: int, percent: int) -> int:
    """Elements that a set of n shares with any linked set."""
    return -(-percent * n // 100)


def _sets(batch: corpus.Batch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and shingle fingerprints, distinct, by text and fingerprint."""
    words = Words(batch.data, batch.lengths, lower=True)
    of = words.text_of_word()
    texts, prints = [], []
    for k in range(1, size + 1):
        found = windows(words.prints, k)
        at = np.flatnonzero(words.window_starts(size)[: len(found)]) if k == size else words.first[:-1][words.counts == k]
        texts.append(of[at])
        prints.append(found[at])
    text, print_ = np.concatenate(texts), np.concatenate(prints)
    order = np.lexsort((print_, text))
    text, print_ = text[order], print_[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(print_) != 0)
    return text[new], print_[new]


def _ask(batch: corpus.Batch, size: int, bits: int) -> pa.Table:
    distinct, counts = np.unique(_sets(batch, size)[1], return_counts=True)
    return corpus.question_rows(batch.number, distinct, corpus.residues(distinct, bits), np.minimum(counts, 255), bits)


def _frequency(keys: list[np.ndarray], notes: list[np.ndarray]) -> list[np.ndarray]:
    """In how many texts each shingle is, 255 for all larger numbers."""
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(which, weights=np.concatenate(notes), minlength=len(distinct))
    return np.split(np.minimum(counts[which], 255).astype(np.uint8), np.cumsum([len(k) for k in keys])[:-1])


_SET_COLUMNS = "row long, n long, print_1 long, print_2 long, elements array<long>, places array<int>, scan long, keys binary, light binary"


def _describe(batch: corpus.Batch, size: int, percent: int, told: np.ndarray) -> dict[str, pa.Array]:
    text, prints = _sets(batch, size)
    frequency = told[np.unique(prints, return_inverse=True)[1]] if len(prints) else np.empty(0, np.uint8)
    order = np.lexsort((prints, frequency, text))
    counts = np.bincount(text, minlength=len(batch.lengths))
    first = np.concatenate(([0], np.cumsum(counts)))
    sums = [np.concatenate(([0], np.cumsum(mix(prints + np.uint64(s))))) for s in (11, 23)]
    out: dict[str, list] = {c: [] for c in ("elements", "places", "scan", "keys", "light")}
    for i, n in enumerate(counts):
        here = order[first[i] : first[i] + _misses(int(n), percent) + 1] if n else order[:0]
        posted = np.flatnonzero(frequency[here] > 1)
        out["elements"].append(prints[here[posted]].view(np.int64))
        out["places"].append(posted.astype(np.int32))
        out["scan"].append(int(frequency[here[posted]].sum(dtype=np.int64)))
        own = prints[first[i] : first[i + 1]]
        out["keys"].append(_pack(own) if len(posted) else None)
        out["light"].append(own.tobytes() if len(posted) and n <= LIGHT_MOST else None)
    signed = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
    return {
        "row": pa.array(batch.rows()),
        "n": pa.array(counts.astype(np.int64)),
        "print_1": pa.array(signed[0]),
        "print_2": pa.array(signed[1]),
        "elements": pa.array(out["elements"], pa.list_(pa.int64())),
        "places": pa.array(out["places"], pa.list_(pa.int32())),
        "scan": pa.array(out["scan"], pa.int64()),
        "keys": pa.array(out["keys"], pa.binary()),
        "light": pa.array(out["light"], pa.binary()),
    }


def _pack(sorted_prints: np.ndarray) -> bytes:
    """The upper 48 bits of sorted fingerprints."""
    return np.ascontiguousarray(sorted_prints[:, None].view(np.uint8).reshape(-1, 8)[:, 8 - _KEY_BITS // 8 :].T).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(_KEY_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : _KEY_BITS // 8] = planes.T
    return out.view(np.uint64).reshape(-1)


def _subsets(n: int, percent: int) -> int:
    return sum(comb(n, j) for j in range(_misses(n, percent) + 1))


def choose_boundary(histogram: list[tuple[int, int, int]], percent: int) -> int:
    """The size up to which sets are light, from (size, sets, list entries met by their scans)."""
    best, cost_of_best, enumerated = 0, None, 0
    scans, sets_of = sum(met for _, _, met in histogram), {n: sets for n, sets, _ in histogram}
    for boundary in range(LIGHT_MOST + 1):
        if boundary:
            enumerated += sets_of.get(boundary, 0) * _subsets(boundary, percent)
        # Sets that larger ones beyond the boundary may link with stay in the lists.
        spared = sum(met for n, _, met in histogram if 100 * n < percent * (boundary + 1))
        cost = enumerated + scans - spared
        if cost_of_best is None or cost < cost_of_best:
            best, cost_of_best = boundary, cost
    return best


def _light_links(nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """A star for the sets that meet in a subset."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for node, raw in zip(part.column("node").to_pylist(), part.column("light").to_pylist(), strict=True):
                spread = mix(np.frombuffer(raw, np.uint64) + np.uint64(37))
                n, whole = len(spread), int(spread.sum(dtype=np.uint64))
                for j in range(_misses(n, percent) + 1):
                    left = np.array([sum(int(spread[k]) for k in c) for c in combinations(range(n), j)] if j > 1 else [int(x) for x in spread] if j else [0], object)
                    cores = np.array([(whole - int(x)) & ((1 << 64) - 1) for x in left], np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cores), *(pa.array(np.full(len(cores), v, np.int64)) for v in (n - j, node, n))], ["core", "size", "node", "n"]
                    )

    cores = nodes.where(F.col("n") <= boundary).select("node", "light").mapInArrow(run, "core long, size long, node long, n long")
    least = cores.groupBy("core", "size").agg(F.min(F.struct("n", "node")).alias("least"), F.count("*").alias("meeting")).where("meeting > 1")
    met = cores.join(least, ["core", "size"]).where("node <> least.node")
    return met.where(F.expr(f"100 * size >= {percent} * (n + least.n - size)")).select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct()


def _possible(percent: int) -> str:
    """Can sets x and y that share the element at these places link, by their sizes?"""
    return (
        f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND "
        f"{100 + percent} * (least(x.place, y.place) + 1 + least(x.n - x.place - 1, y.n - y.place - 1)) >= {percent} * (x.n + y.n)"
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, judged on the whole sets."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            linked = []
            for x, y in zip(part.column("keys_a"), part.column("keys_b"), strict=True):
                one, other = _unpack(x.as_py()), _unpack(y.as_py())
                at = np.minimum(np.searchsorted(one, other), len(one) - 1)
                common = int((one[at] == other).sum())
                linked.append(100 * common >= percent * (len(one) + len(other) - common))
            yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    keyed = [sets.select(F.col("node").alias(c), F.col("keys").alias(f"keys_{c}")) for c in ("a", "b")]
    return pairs.join(keyed[1], "b").join(keyed[0], "a").select("a", "b", "keys_a", "keys_b").mapInArrow(run, "a long, b long")


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least number in the component of each row of a symmetric link matrix."""
    roots = np.arange(len(linked))
    while True:
        least = np.minimum(roots, np.where(linked, roots[None, :], len(roots)).min(1, initial=len(roots)))
        least = least[least]
        if np.array_equal(least, roots):
            return roots
        roots = least


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, as products of parts of the incidence matrix."""
    all_, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    distinct, which, counts = np.unique(all_, return_inverse=True, return_counts=True)
    # Elements of one set add nothing between sets.
    column = np.cumsum(counts > 1) - 1
    shared = counts[which] > 1
    of, at = of[shared], column[which[shared]]
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int((counts > 1).sum()), width):
        low, high = np.searchsorted(at, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[of[low:high], at[low:high] - start] = 1
        total += part @ part.T
    np.fill_diagonal(total, [len(x) for x in sets])
    return total


def _tile_links(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join components among the sets of two tiles, as stars."""
    group = group.drop_duplicates("node").sort_values("node", ignore_index=True)
    common = overlaps([_unpack(k) for k in group["keys"]]).astype(np.int64)
    n, part = group["n"].to_numpy(), group["part"].to_numpy()
    linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    linked &= part[:, None] != part[None, :]
    roots, node = _roots(linked), group["node"].to_numpy()
    joined = roots != np.arange(len(node))
    return pd.DataFrame({"a": node[roots[joined]], "b": node[joined]})


def _remaining_links(scratch: Scratch, postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets of lists that still hold several components.

    Sets that such lists connect form a block.  A block is cut by set size into tiles of bounded
    number; two tiles meet in a task if some list has sets of both and their sizes are within reach, and the task compares
    all their sets at once.  So the work on a group of copies is a matter of matrix products, and no pair is a row.
    """
    stars = postings.groupBy("element").agg(F.min("node").alias("a")).join(postings.select("element", F.col("node").alias("b")), "element")
    blocks = components(scratch, stars.where("a <> b"))
    members = postings.groupBy("node").agg(F.first("n").alias("n"), F.first("part").alias("part")).join(blocks, "node")
    by = Window.partitionBy("label").orderBy("n", "node")
    members = scratch.keep(members.withColumn("tile", F.floor((F.row_number().over(by) - 1) / TILE)), "members")
    tiles = members.groupBy("label", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    held = postings.select("element", "node").join(members.select("node", "label", "tile"), "node").select("element", "label", "tile").distinct()
    held = held.join(tiles, ["label", "tile"])
    x, y = (held.select("element", "label", F.struct("tile", "low", "high").alias(c)) for c in ("x", "y"))
    several = held.groupBy("element").agg(F.count("*").alias("tiles")).where("tiles > 1").select("element")
    across = x.join(several, "element").join(y, ["element", "label"]).where(f"x.tile < y.tile AND 100 * x.high >= {percent} * y.low")
    meetings = across.select("label", F.col("x.tile").alias("x"), F.col("y.tile").alias("y")).distinct()
    meetings = meetings.unionByName(tiles.select("label", F.col("tile").alias("x"), F.col("tile").alias("y")))
    sides = meetings.select("label", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("tile"))
    together = members.join(sides, ["label", "tile"]).join(sets.select("node", "keys"), "node")
    return together.groupBy("label", "x", "y").applyInPandas(lambda group: _tile_links(group, percent), "a long, b long")


def _heavy_links(scratch: Scratch, nodes: DataFrame, light: DataFrame, boundary: int, percent: int) -> DataFrame:
    sets = nodes.where(100 * F.col("n") >= percent * (boundary + 1))
    entries = sets.select("node", "n", F.explode(F.arrays_zip("elements", "places")).alias("entry"))
    postings = entries.select(F.col("entry.elements").alias("element"), F.col("entry.places").alias("place"), "node", "n")
    postings = scratch.keep(postings, "postings")
    # Neighbours in a list by size: most sets of a group of copies link so, for a pair or two each.
    by = Window.partitionBy("element").orderBy("n", "node")
    met = postings.select(F.struct("node", "n", "place").alias("x"), F.lag(F.struct("node", "n", "place")).over(by).alias("y"))
    met = met.where("y IS NOT NULL").where(_possible(percent))
    pairs = met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    links = scratch.keep(light.unionByName(_verified(pairs, sets, percent)), "links")
    labels = components(scratch, links)
    now = postings.join(labels, "node", "left").withColumn("part", F.coalesce("label", "node")).drop("label")
    # Lists whose sets are all in one component are done with.
    apart = now.groupBy("element").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most").select("element")
    apart = scratch.keep(now.join(apart, "element"), "apart")
    if apart.isEmpty():
        return links
    return links.unionByName(scratch.keep(_remaining_links(scratch, apart, sets, percent), "links"))


def similar_groups(scratch: Scratch, df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """Group texts by links between their sets of ``size``-word shingles; A-Z count as a-z.

    Returns the stored batches of ``df`` (see ``corpus.store``) and one row per row of it: ``row`` (its number there), the key column, ``n_shingles``,
    ``component_id`` (the smallest key of its group) and ``first`` (is it the group's first by key and row?).  Texts of
    fewer words are one shingle; empty, blank and null texts have none and link with nothing.  Repeated rows
    link if they have words.  Rows without a key group like others; a group with no key at all has a null
    ``component_id``.  Other columns take no part, whatever their names.
    """
    batches = corpus.store(scratch, df, text)
    bits = corpus.range_bits(batches, 1 / 6)
    told = scratch.keep(corpus.answer(corpus.ask(batches, lambda b: _ask(b, size, bits)), _frequency, np.uint32), "frequency")
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField("key", key_type), *T._parse_datatype_string(_SET_COLUMNS)])

    def describe(batch: corpus.Batch, others: pa.StructArray, said: list[np.ndarray]) -> pa.Table:
        return pa.table({"key": others.field(key)} | _describe(batch, size, percent, said[0]))

    sets = scratch.keep(corpus.with_answers(batches, [told], describe, schema), "sets")
    same = ["n", "print_1", "print_2"]
    nodes = scratch.keep(sets.where("n > 0").groupBy(*same).agg(F.min("row").alias("node")), "nodes")
    able = sets.where("keys IS NOT NULL").join(nodes.select("node"), F.col("row") == F.col("node"), "left_semi").withColumnRenamed("row", "node")
    histogram = able.where(F.col("n") <= LIGHT_MOST).groupBy("n").agg(F.count("*").alias("sets"), F.sum("scan").alias("met")).collect()
    boundary = choose_boundary([(r["n"], r["sets"], r["met"]) for r in histogram], percent)
    links = _heavy_links(scratch, able, _light_links(able, boundary, percent), boundary, percent)
    labels = components(scratch, links)
    placed = sets.select("row", "key", *same).join(nodes, same, "left").join(labels, "node", "left")
    placed = scratch.keep(placed.select("row", "key", "n", F.coalesce("label", "node").alias("part")), "placed")
    order = F.struct(F.col("key").isNull().alias("missing"), F.col("key").alias("key"), F.col("row").alias("row"))
    firsts = placed.where("part IS NOT NULL").groupBy("part").agg(F.min(order).alias("least"))
    out = placed.join(firsts, "part", "left").select(
        "row",
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("part").isNull(), F.col("key")).otherwise(F.col("least.key")).alias("component_id"),
        (F.col("part").isNull() | (F.col("least.row") == F.col("row"))).alias("first"),
    )
    return batches, out


def keep_first(scratch: Scratch, df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` less all but the first of each group, in the columns of ``df``."""
    batches, groups = similar_groups(scratch, df, key, text, size, percent)
    return corpus.pick(batches, groups.where("first"), text).select(*[F.col(f"`{c}`") for c in df.columns])
