"""Alignment of two tokenizers' tokens by the bytes they cover: an associative monoid of fragments.

Byte offsets at which tokens of both sides end cut them into groups.  Ordinary
texts are tokenised and aligned whole, many at a time.  A very long text is cut into
ranges that different tasks take; each tokenizer moves a range's edge on to the
next place where none of its tokens can cross, so the two edges may differ.  A
range yields a ``Fragment``: an open prefix (tokens before its first common end), closed
groups, and an open suffix.  Only open ends travel: ``join`` composes neighbouring
fragments, closes what lies between them, and is associative, so the fragments of a
text are reduced as a tree, level by level, in as many tasks as a level has nodes.

How many documents hold a pair of ids linked is counted over the corpus from each
batch's distinct pairs, and told to the batches that asked.

A batch travels compressed and is aligned a piece at a time, so that a task's memory
does not depend on what a batch or a file holds.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.corpus import release
from tickloom.llm.rowwise import slices
from tickloom.session import Scratch, arrow_batches

#: Characters of a range of a long text (texts up to this length are one piece), bytes of text and rows of a batch, fragments composed at a time.
RANGE_CHARS = 1 << 16
BATCH_BYTES = 2 << 20
BATCH_ROWS = 1 << 16
FAN = 16
#: Tokens of side a aligned at a time (a text's are not divided), bytes handed to a worker at a time and bytes of a row group of batches.
PIECE_TOKENS = 1 << 17
HANDED_BYTES = 4 << 20

#: No token of the byte-level side has a letter or digit before white space or punctuation ...
_EDGE_A = re.compile(r"(?<=[^\W_])(?=[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])")
#: ... and none of the piece side a space after anything but spaces (``Tokenizers`` checks its vocabulary).
_EDGE_B = re.compile("(?<=[^ ▁])(?= [^ ▁])")
#: So long a run of white space is beyond the fast encoder's pattern matcher.
_BLANK = re.compile(r"\s{5000}")

IDS = np.dtype("<u2")
PAIRS = "unit long, row long, pair long, n long"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def default_paths() -> tuple[str, str, str]:
    """The byte-level vocabulary as ranks and as a tokenizer's file, and the piece model."""
    from public_tokenizers import path

    return path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


class Tokenizers:
    """Both tokenizers of a worker, and the bytes of each id."""

    def __init__(self, ranks: str, full: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        known = load_tiktoken_bpe(ranks)
        self.full_path, self.full = full, None
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_a = [b""] * (max(known.values()) + 1)
        for token, number in known.items():
            self.bytes_a[number] = token
        self.bytes_b = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece has a space after other characters: texts cannot be cut before spaces")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)

    def encode_a(self, text: str) -> list[int]:
        if _BLANK.search(text):
            if self.full is None:
                from tokenizers import Tokenizer

                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                self.full = Tokenizer.from_file(self.full_path)
                self.full.encode_special_tokens = True
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, part_a: str, part_b: str) -> tuple[list[int], list[int], bool]:
        """Ids of two parts that begin with the space both sides put first, and whether each side's tokens hold its part's bytes."""
        a = self.encode_a(part_a)
        b = self.pieces.encode(part_b[1:]) if part_b else []
        same = b"".join([self.bytes_a[i] for i in a]) == part_a.encode() and b"".join([self.bytes_b[i] for i in b]) == part_b.encode()
        return a, b, same


@lru_cache(1)
def _tokenizers(paths: tuple[str, str, str]) -> Tokenizers:
    return Tokenizers(*paths)


# --- fragments -----------------------------------------------------------------------------------


@dataclass
class Fragment:
    """Tokens of a byte range: before the first common end, and after the last; with no common end, all of them are prefix.

    start_a, start_b: offsets at which the prefix begins on either side; cut: offset of the last common end, or -1.
    """

    start_a: int
    start_b: int
    prefix_a: np.ndarray
    prefix_b: np.ndarray
    cut: int
    suffix_a: np.ndarray
    suffix_b: np.ndarray


Closed = tuple[np.ndarray, np.ndarray]


def split(tokens: Tokenizers, start_a: int, start_b: int, a: np.ndarray, b: np.ndarray) -> tuple[Fragment, Closed]:
    """The fragment of tokens that begin at these offsets, and the tokens of its closed groups."""
    ends_a = start_a + np.concatenate(([0], np.cumsum(tokens.length_a[a])))
    ends_b = start_b + np.concatenate(([0], np.cumsum(tokens.length_b[b])))
    common, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    if not len(common):
        return Fragment(start_a, start_b, a, b, -1, a[:0], b[:0]), (a[:0], b[:0])
    first_a, last_a, first_b, last_b = at_a[0], at_a[-1], at_b[0], at_b[-1]
    return Fragment(start_a, start_b, a[:first_a], b[:first_b], int(common[-1]), a[last_a:], b[last_b:]), (a[first_a:last_a], b[first_b:last_b])


def join(tokens: Tokenizers, left: Fragment, right: Fragment) -> tuple[Fragment, Closed]:
    """Neighbours as one fragment, and the tokens of the groups that this closes."""
    if left.cut < 0:
        start_a, start_b, open_a, open_b = left.start_a, left.start_b, left.prefix_a, left.prefix_b
    else:
        start_a = start_b = left.cut
        open_a, open_b = left.suffix_a, left.suffix_b
    middle, closed = split(tokens, start_a, start_b, np.concatenate((open_a, right.prefix_a)), np.concatenate((open_b, right.prefix_b)))
    if right.cut >= 0:  # the middle ends at the right one's first common end
        cut, suffix_a, suffix_b = right.cut, right.suffix_a, right.suffix_b
    else:
        cut, suffix_a, suffix_b = middle.cut, middle.suffix_a, middle.suffix_b
    if left.cut < 0:
        return Fragment(left.start_a, left.start_b, middle.prefix_a, middle.prefix_b, cut, suffix_a, suffix_b), closed
    return Fragment(left.start_a, left.start_b, left.prefix_a, left.prefix_b, cut, suffix_a, suffix_b), closed


# --- groups and links of many documents at a time ------------------------------------------------


class Aligned:
    """Tokens of several texts one after the other; either side covers the same bytes of each text."""

    def __init__(self, tokens: Tokenizers, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        ends_a, ends_b = np.cumsum(tokens.length_a[a]), np.cumsum(tokens.length_b[b])
        first = np.searchsorted(ends_b, ends_a - tokens.length_a[a], "right")
        last = np.searchsorted(ends_b, ends_a, "left")
        self.closes_a = ends_b[last] == ends_a if len(a) else np.zeros(0, bool)
        self.closes_b = np.zeros(len(b), bool)
        self.closes_b[last[self.closes_a]] = True
        self.first, self.per_token = first, last - first + 1
        self.edges_a, self.edges_b = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))

    def groups(self) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(self.closes_a)))[self.edges_a])

    def link_edges(self) -> np.ndarray:
        """Where each text's links begin, and the end."""
        return np.concatenate(([0], np.cumsum(self.per_token)))[self.edges_a]

    def links(self) -> np.ndarray:
        """Every pair of tokens that share a byte: id of a in the high half, id of b in the low one."""
        begins = np.cumsum(self.per_token) - self.per_token
        at = np.repeat(self.first - begins, self.per_token) + np.arange(int(self.per_token.sum()))
        return np.repeat(self.a.astype(np.uint32) << np.uint32(16), self.per_token) | self.b[at].astype(np.uint32)

    def distinct_links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, and how many of the texts hold each."""
        links = self.links().astype(np.int64)
        text = np.repeat(np.arange(len(self.n_a)), np.diff(self.link_edges()))
        return np.unique(np.unique((text << 32) | links) & 0xFFFFFFFF, return_counts=True)

    def written(self) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text."""
        group_a = np.cumsum(self.closes_a) - self.closes_a
        group_b = np.cumsum(self.closes_b) - self.closes_b
        order = np.empty(len(self.a) + len(self.b), np.int64)
        table = _written_ids()
        order[np.arange(len(self.a)) + np.searchsorted(group_b, group_a, "left")] = self.a.astype(np.int64) * 4 + self.closes_a
        order[np.arange(len(self.b)) + np.searchsorted(group_a, group_b, "right")] = self.b.astype(np.int64) * 4 + 2 + self.closes_b
        parts = [table[k] for k in order.tolist()]
        edges = (self.edges_a + self.edges_b).tolist()
        return ["".join(parts[p:q])[:-1] for p, q in zip(edges[:-1], edges[1:], strict=True)]


def distinct_links(pieces: Iterator[Aligned]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of all pieces, and how many of their texts hold each."""
    pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for aligned in pieces:
        some, held = aligned.distinct_links()
        pairs, at = np.unique(np.concatenate((pairs, some)), return_inverse=True)
        n = np.bincount(at, np.concatenate((n, held)), len(pairs)).astype(np.int64)
    return pairs, n


@lru_cache(1)
def _written_ids() -> list[str]:
    """Each id before a comma or bar (side a), before a comma or semicolon (side b)."""
    return [f"{i}{mark}" for i in range(1 << 16) for mark in ",|,;"]


def _packed(ids: np.ndarray) -> bytes:
    return pa.Codec("zstd", 3).compress(ids.tobytes(), asbytes=True) if len(ids) else b""


def _unpacked(raw: bytes, n: np.ndarray) -> np.ndarray:
    size = int(n.sum()) * IDS.itemsize
    return np.frombuffer(pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if size else b"", IDS)


def _pieces(unit: pa.RecordBatch | pa.Table, tokens: Tokenizers) -> Iterator[Aligned]:
    """The texts of a unit, in order, as many at a time as have ``PIECE_TOKENS``."""
    n_a, n_b = (np.frombuffer(unit.column(c)[0].as_py(), np.int64) for c in ("n_a", "n_b"))
    a, b = (_unpacked(unit.column(c)[0].as_py(), n) for c, n in (("ids_a", n_a), ("ids_b", n_b)))
    edges_a, edges_b = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))
    at = 0
    while at < len(n_a):
        to = max(at + 1, int(np.searchsorted(edges_a, edges_a[at] + PIECE_TOKENS, "right")) - 1)
        yield Aligned(tokens, a[edges_a[at] : edges_a[to]], n_a[at:to], b[edges_b[at] : edges_b[to]], n_b[at:to])
        at = to


# --- Spark ---------------------------------------------------------------------------------------

#: How tables of large cells are written: sizes are looked at after each row, as a reader has whole row groups and pages in memory.
_STORED = {"compression": "zstd", "parquet.block.size": str(HANDED_BYTES), "parquet.page.size.row.check.min": "1"}


def _short_units(scratch: Scratch, short: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """Batches of tokenised texts; those without tokens have none."""
    key = short.schema["key"].dataType
    schema = T.StructType().add("unit", "long").add("keys", T.ArrayType(key))
    for name in ("n_a", "n_b", "ids_a", "ids_b"):
        schema = schema.add(name, "binary")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, unit = _tokenizers(paths), TaskContext.get().partitionId() << 24
        keys, a, b, held = [], [], [], 0

        def batch() -> pa.RecordBatch:
            of_batch = pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.concat_arrays(keys))
            sizes = (np.array([len(x) for x in side], np.int64).tobytes() for side in (a, b))
            cells = [pa.array([x], pa.binary()) for x in (*sizes, *(_packed(np.concatenate(side)) for side in (a, b)))]
            return pa.RecordBatch.from_arrays([pa.array([unit]), of_batch, *cells], names=schema.names)

        for part in parts:
            for at, take in slices(part.column("text"), BATCH_BYTES // 8, BATCH_ROWS // 8):
                some = part.slice(at, take)
                for text in some.column("text").to_pylist():
                    one, other, same = tokens.encode(f" {text}", f" {text}") if text else ((), (), False)
                    a.append(np.array(one if same else (), IDS))
                    b.append(np.array(other if same else (), IDS))
                keys.append(some.column("key"))
                held += pc.sum(pc.binary_length(some.column("text"))).as_py() or 0
                if held >= BATCH_BYTES or len(a) >= BATCH_ROWS:
                    yield batch()
                    unit, held = unit + 1, 0
                    keys, a, b = [], [], []
                    release()
        if a:
            yield batch()
        release()

    return scratch.keep(short.mapInArrow(run, schema), "units", **_STORED)


def edges(text: str, edge: re.Pattern, width: int) -> list[int]:
    """Begins of the ranges of ``width`` characters, moved on to where ``edge`` allows, and the end."""
    found = [0]
    for nominal in range(width, len(text), width):
        if found[-1] < nominal:
            match = edge.search(text, nominal)
            found.append(match.start() if match else len(text))
        else:
            found.append(found[-1])
    return [*found, len(text)]


def _ranges(scratch: Scratch, long: DataFrame) -> DataFrame:
    """Long texts cut into ranges: a text's parts for either side, and the byte offsets at which they begin."""
    schema = T.StructType().add("row", "long").add("chunk", "integer").add("chunks", "integer").add("key", long.schema["key"].dataType)
    schema = schema.add("start_a", "long").add("part_a", "string").add("start_b", "long").add("part_b", "string")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            for i in range(part.num_rows):
                text = f" {part.column('text')[i].as_py()}"
                columns = []
                for edge in (_EDGE_A, _EDGE_B):
                    at = edges(text, edge, RANGE_CHARS)
                    pieces = [text[p:q] for p, q in zip(at[:-1], at[1:], strict=True)]
                    columns += [np.concatenate(([0], np.cumsum([len(p.encode()) for p in pieces])))[:-1], pieces]
                n = len(columns[1])
                keys = part.column("key").slice(i, 1).take(pa.array(np.zeros(n, np.int64)))
                fixed = [pa.array(np.full(n, row)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, n, np.int32)), keys]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2]), pa.array(columns[3])], names=schema.names)
                row += 1

    return scratch.keep(long.mapInArrow(run, schema), "ranges", **_STORED)


#: A fragment (closed is false) or closed groups, whose place among those of the text is ``place``.
_NODE = "row long, place long, closed boolean, same boolean, start_a long, start_b long, cut long, prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary"


def _fragment_row(row: int, place: int, same: bool, f: Fragment) -> tuple:
    return (row, place, False, same, f.start_a, f.start_b, f.cut, *(x.astype(IDS).tobytes() for x in (f.prefix_a, f.prefix_b, f.suffix_a, f.suffix_b)))


def _closed_row(row: int, place: int, closed: Closed) -> tuple:
    return (row, place, True, True, 0, 0, 0, closed[0].astype(IDS).tobytes(), closed[1].astype(IDS).tobytes(), b"", b"")


def _node_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


_NODE_ARROW = pa.schema(
    [("row", pa.int64()), ("place", pa.int64()), ("closed", pa.bool_()), ("same", pa.bool_()), ("start_a", pa.int64()), ("start_b", pa.int64()), ("cut", pa.int64())]
    + [(n, pa.binary()) for n in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")]
)


def _leaves(scratch: Scratch, ranges: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """The fragment and the closed groups of each range, tokenised by whichever task gets it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokenizers(paths)
        for part in parts:
            for i in range(part.num_rows):
                r = {n: part.column(n)[i].as_py() for n in ("row", "chunk", "start_a", "part_a", "start_b", "part_b")}
                a, b, same = tokens.encode(r["part_a"], r["part_b"])
                fragment, closed = split(tokens, r["start_a"], r["start_b"], np.array(a, IDS), np.array(b, IDS))
                rows = [_fragment_row(r["row"], 2 * r["chunk"], same, fragment)]
                if same and len(closed[0]):
                    rows.append(_closed_row(r["row"], 2 * r["chunk"], closed))
                yield from _node_table(rows, _NODE_ARROW).to_batches()

    spread = ranges.drop("key", "chunks").repartition("row", "chunk")
    return scratch.keep(spread.mapInArrow(run, _NODE), "nodes", **_STORED)


def _reduce(scratch: Scratch, leaves: DataFrame, chunks: int, paths: tuple[str, str, str]) -> DataFrame:
    """Closed groups of all long texts: fragments are composed as a tree of ``FAN`` branches a node."""

    def compose(table: pa.Table) -> pa.Table:
        tokens, rows = _tokenizers(paths), []
        whole, same, place, furthest = None, True, 0, 0
        for r in sorted(table.to_pylist(), key=lambda r: r["place"]):
            ids = [np.frombuffer(r[n], IDS) for n in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")]
            fragment = Fragment(r["start_a"], r["start_b"], *ids[:2], r["cut"], *ids[2:])
            if whole is None:
                whole, place = fragment, r["place"]
            else:
                whole, closed = join(tokens, whole, fragment)
                if len(closed[0]):
                    # Between the closed groups before this fragment and its own.
                    rows.append(_closed_row(r["row"], r["place"] - 1, closed))
            same &= r["same"]
        rows.append(_fragment_row(table.column("row")[0].as_py(), place, same, whole))
        return _node_table(rows, _NODE_ARROW)

    closed, level, width = leaves.where("closed"), leaves.where("NOT closed"), 2
    while chunks > 1:
        width, chunks = width * FAN, -(-chunks // FAN)
        node = F.floor(F.col("place") / width).alias("node")
        done = scratch.keep(level.groupBy("row", node).applyInArrow(compose, _NODE), "nodes", **_STORED)
        closed, level = closed.unionByName(done.where("closed")), done.where("NOT closed")
    kept = closed.join(level.where("NOT same").select("row"), "row", "left_anti")
    return kept.select("row", "place", F.col("prefix_a").alias("ids_a"), F.col("prefix_b").alias("ids_b"))


def _long_units(scratch: Scratch, ranges: DataFrame, chunks: int, paths: tuple[str, str, str]) -> DataFrame:
    """Closed groups of long texts as units, each of the tokens of one text."""
    closed = scratch.keep(_reduce(scratch, _leaves(scratch, ranges, paths), chunks, paths), "closed", **_STORED)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = -1 - (TaskContext.get().partitionId() << 40)
        for part in parts:
            for i in range(part.num_rows):
                some = part.slice(i, 1)
                ids = [np.frombuffer(some.column(c)[0].as_py(), IDS) for c in ("ids_a", "ids_b")]
                cells = [pa.array([x], pa.binary()) for x in (*(np.array([len(x)], np.int64).tobytes() for x in ids), *map(_packed, ids))]
                yield pa.RecordBatch.from_arrays([pa.array([unit]), some.column("row"), some.column("place"), *cells], names=schema.names)
                unit -= 1
        release()

    schema = T.StructType().add("unit", "long").add("row", "long").add("place", "long")
    for name in ("n_a", "n_b", "ids_a", "ids_b"):
        schema = schema.add(name, "binary")
    return scratch.keep(closed.mapInArrow(run, schema), "long", **_STORED)


def _pairs(scratch: Scratch, units: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """Each unit's distinct pairs, and how many of its texts hold them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokenizers(paths)
        for part in parts:
            for i in range(part.num_rows):
                some = part.slice(i, 1)
                pairs, n = distinct_links(_pieces(some, tokens))
                same = pa.array(np.zeros(len(pairs), np.int64))
                yield pa.RecordBatch.from_arrays([some.column("unit").take(same), some.column("row").take(same), pa.array(pairs), pa.array(n)], names=["unit", "row", "pair", "n"])
        release()

    row = F.col("row") if "row" in units.columns else F.lit(None).cast("long").alias("row")
    return scratch.keep(units.select("unit", row, "n_a", "n_b", "ids_a", "ids_b").mapInArrow(run, PAIRS), "pairs")


def _pair_counts(scratch: Scratch, short: DataFrame, long: DataFrame | None) -> DataFrame:
    """How many documents hold each pair, and whether no other pair of its id of side a is held by more."""
    held = short.select("pair", "n")
    if long is not None:  # a long text's groups are spread over units: it counts once
        held = held.unionByName(long.select("row", "pair").distinct().select("pair", F.lit(1).cast("long").alias("n")))
    counts = held.groupBy("pair").agg(F.sum("n").alias("count"))
    # An id of side a has at most as many pairs as side b has ids.
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 16)))
    return scratch.keep(counts.select("pair", "count", (F.col("count") == most).alias("best")), "counts")


def _measured(units: DataFrame, pairs: DataFrame, counts: DataFrame, paths: tuple[str, str, str], kept: T.StructType, written: bool) -> DataFrame:
    """The measures of each text of each unit; ``kept`` names a column with a value for each text, ``written`` asks for the digest."""
    schema = T.StructType(list(kept.fields))
    for name in MEASURES:
        schema = schema.add(name, "long")
    if written:
        schema = schema.add("groups_sha256", "string")
    name = kept.names[0]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({f.name: [] for f in schema})
        pair, count, best = (right.column(c).to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(pair)
        pair, count, best = pair[order], count[order], best[order]
        measures, digests = [], []
        for aligned in _pieces(left, _tokenizers(paths)):
            at = np.searchsorted(pair, aligned.links())
            edge = aligned.link_edges()
            best_of, sum_of = (np.diff(np.concatenate(([0], np.cumsum(v[at].astype(np.int64))))[edge]) for v in (best, count))
            measures.append(np.stack((aligned.n_a, aligned.n_b, aligned.groups(), np.diff(edge), best_of, sum_of)))
            if written:
                digests += [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in aligned.written()]
        column = left.column(name)
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        of_text = column.flatten() if pa.types.is_list(column.type) else column
        columns = [of_text, *map(pa.array, np.concatenate(measures, axis=1))]
        if written:
            columns.append(pa.array(digests, pa.string()))
        aligned = at = None
        release()
        return pa.Table.from_arrays(columns, names=schema.names)

    told = pairs.select("unit", "pair").join(counts, "pair")
    return units.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(run, schema)


def _digests(long: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """The digest of each long text's written groups; a unit at a time is in memory."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, row, digest = _tokenizers(paths), None, hashlib.sha256()
        one = lambda: pa.RecordBatch.from_arrays([pa.array([row]), pa.array([digest.hexdigest()])], names=["row", "groups_sha256"])
        for part in parts:
            for i in range(part.num_rows):
                some = part.slice(i, 1)
                now = some.column("row")[0].as_py()
                if row is not None and now != row:
                    yield one()
                    digest = hashlib.sha256()
                elif row is not None:
                    digest.update(b";")
                row = now
                for aligned in _pieces(some, tokens):
                    digest.update(aligned.written()[0].encode())
        if row is not None:
            yield one()
        release()

    return long.repartition("row").sortWithinPartitions("row", "place").mapInArrow(run, "row long, groups_sha256 string")


def align(scratch: Scratch, df: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Align the tokens of each text: the key column, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Both sides tokenise the text after a space, without special tokens.  Links are pairs of tokens that share a byte; a pair of ids
    counts the rows whose text holds it linked; ``n_best`` counts links whose pair no other pair of the same id of side a exceeds, ``count_sum``
    adds up the pairs' counts over links.  The digest is of the groups written as ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that either side's tokens do not give back byte for byte, have no tokens: zeros and an empty digest.
    Very long texts are cut into ranges and composed again, whatever they hold; one without any place to cut is tokenised in one piece.
    Repeated rows, also with equal keys, count and are returned each; an empty table gives none.  Other columns take no part, whatever their names.
    """
    paths = paths or default_paths()
    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    key_type = df.schema[key].dataType
    with arrow_batches(df.sparkSession, HANDED_BYTES):
        found = _aligned(scratch, given, T.StructType().add("key", key_type), paths)
    return found.select(F.col("key").alias(key), *MEASURES, "groups_sha256")


def _aligned(scratch: Scratch, given: DataFrame, key: T.StructType, paths: tuple[str, str, str]) -> DataFrame:
    is_long = F.coalesce(F.length("text"), F.lit(0)) > RANGE_CHARS
    short = _short_units(scratch, given.where(~is_long), paths)
    ranges = _ranges(scratch, given.where(is_long))
    chunks = ranges.agg(F.max("chunks")).first()[0]
    short_pairs = _pairs(scratch, short, paths)
    if chunks is None:
        counts = _pair_counts(scratch, short_pairs, None)
        return _measured(short.withColumnRenamed("keys", "key"), short_pairs, counts, paths, key, True)
    long = _long_units(scratch, ranges, chunks, paths)
    long_pairs = _pairs(scratch, long, paths)
    digests = scratch.keep(_digests(long, paths), "digests")
    counts = _pair_counts(scratch, short_pairs, long_pairs)
    found = _measured(short.withColumnRenamed("keys", "key"), short_pairs, counts, paths, key, True)
    parts = _measured(long, long_pairs, counts, paths, T.StructType().add("row", "long"), False)
    sums = parts.groupBy("row").agg(*[F.sum(m).alias(m) for m in MEASURES])
    whole = ranges.where("chunk = 0").select("row", "key").join(sums, "row", "left").join(digests, "row", "left")
    return found.unionByName(whole.select("key", *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
