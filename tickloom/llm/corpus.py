"""A corpus stored as batches of rows, and questions about fingerprints put to all batches.

Operators that compare every text with all others work in rounds.  Texts are
stored once as compressed batches with lasting numbers.  In a round each batch
sends its distinct fingerprints, packed by hash range, to the range's task; the
task answers for each of them from what all batches sent, and the answers come
back to the batch, which knows the order it asked in.  A fingerprint shared by
any number of rows counts once per batch, so a hot one does not swell its range.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import Scratch

#: Bytes of text in a batch, and distinct fingerprints a range should hold.
BATCH_BYTES = 2 << 20
BATCH_ROWS = 1 << 16
RANGE_ROWS = 500_000
MOST_BITS = 18


def release() -> None:
    """Give freed memory back to the machine: an executor's idle workers keep theirs otherwise, beside those at work."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries give it back by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Batch:
    """Texts of one batch in memory: ``data`` has them with a newline between neighbours."""

    def __init__(self, number: int, lengths: np.ndarray, blob: bytes):
        self.number = number
        self.null = lengths < 0
        self.lengths = np.maximum(lengths, 0)
        size = int(self.lengths.sum()) + max(0, len(lengths) - 1)
        raw = pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        self.bytes = raw
        self.data = np.frombuffer(raw, np.uint8)
        self.begins = np.concatenate(([0], np.cumsum(self.lengths + 1)))[:-1]

    def rows(self) -> np.ndarray:
        """Lasting numbers of the rows."""
        return np.int64(self.number) * BATCH_ROWS + np.arange(len(self.lengths))

    def text(self, i: int) -> bytes:
        return self.bytes[self.begins[i] : self.begins[i] + self.lengths[i]]


def store(scratch: Scratch, df: DataFrame, text: str) -> DataFrame:
    """Write ``df`` as batches: number, the rows' other columns, lengths (-1: null) and the compressed texts."""
    rest = T.StructType([f for f in df.schema.fields if f.name != text])
    packed = df.select(
        F.struct(*[F.col(f"`{f.name}`") for f in rest]).alias("rest") if len(rest) else F.struct(F.lit(None).cast("int").alias("nothing")).alias("rest"),
        F.col(f"`{text}`").cast("string").cast("binary").alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField("batch", T.LongType()),
            T.StructField("rest", T.ArrayType(packed.schema["rest"].dataType)),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("blob", T.BinaryType()),
            T.StructField("size", T.LongType()),
        ]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        waiting: list[pa.RecordBatch] = []
        held = 0

        def row() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            texts = table.column("text").to_pylist()
            rest = table.column("rest").combine_chunks()
            if isinstance(rest, pa.ChunkedArray):
                rest = pa.concat_arrays(rest.chunks)
            lengths = np.array([-1 if t is None else len(t) for t in texts], np.int64)
            raw = b"\n".join(t or b"" for t in texts)
            blob = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
            lists = pa.ListArray.from_arrays(pa.array([0, len(rest)], pa.int32()), rest)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), lists, pa.array([lengths.tobytes()]), pa.array([blob]), pa.array([len(raw)])], ["batch", "rest", "lengths", "blob", "size"]
            )

        for part in parts:
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < part.num_rows:
                room = np.searchsorted(np.cumsum(sizes[at:]), BATCH_BYTES - held, "right")
                take = min(part.num_rows - at, max(int(room), 0 if waiting else 1), BATCH_ROWS - sum(w.num_rows for w in waiting))
                if take:
                    waiting.append(part.slice(at, take))
                    held += int(sizes[at : at + take].sum())
                    at += take
                if at < part.num_rows or held >= BATCH_BYTES:
                    yield row()
                    number, held = number + 1, 0
                    waiting = []
        if waiting:
            yield row()
        waiting = []
        release()

    return scratch.keep(packed.mapInArrow(run, schema), "batches")


def batches_of(table: pa.RecordBatch | pa.Table) -> Iterator[Batch]:
    for number, lengths, blob in zip(*(table.column(c).to_pylist() for c in ("batch", "lengths", "blob")), strict=True):
        yield Batch(number, np.frombuffer(lengths, np.int64), blob)


def range_bits(batches: DataFrame, per_byte: float) -> int:
    """Bits of a fingerprint that name its range, from the size of the corpus."""
    size = batches.agg(F.sum("size")).first()[0] or 0
    return int(min(MOST_BITS, max(4, np.ceil(np.log2(max(1.0, size * per_byte / RANGE_ROWS))))))


def cut(sorted_prints: np.ndarray, bits: int) -> np.ndarray:
    """Where each range begins in sorted fingerprints, and the end."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(sorted_prints, edges), len(sorted_prints))


def planes(values: np.ndarray) -> bytes:
    """Numbers by byte, the highest last: the high bytes of sorted numbers compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def residues(sorted_prints: np.ndarray, bits: int, further: np.ndarray | None = None) -> np.ndarray:
    """The 32 bits that follow those naming the range; with further fingerprints all bits, and as many of theirs."""
    shifted = sorted_prints << np.uint64(bits)
    if further is None:
        return (shifted >> np.uint64(32)).astype(np.uint32)
    return shifted | (further >> np.uint64(64 - bits))


QUESTION = "batch long, bucket int, keys binary, notes binary"
ANSWER = "batch long, bucket int, answer binary"


def question_rows(number: int, prints: np.ndarray, keys: np.ndarray, notes: np.ndarray, bits: int) -> pa.Table:
    """One row for each range that some of a batch's sorted distinct fingerprints fall into.

    keys: what tells fingerprints of a range apart; notes: a byte about each.
    """
    edges = cut(prints, bits)
    used = np.flatnonzero(np.diff(edges))
    return pa.table(
        {
            "batch": pa.array(np.full(len(used), number, np.int64)),
            "bucket": pa.array(used.astype(np.int32)),
            "keys": pa.array([planes(keys[edges[b] : edges[b + 1]]) for b in used], pa.binary()),
            "notes": pa.array([notes[edges[b] : edges[b + 1]].astype(np.uint8).tobytes() for b in used], pa.binary()),
        }
    )


def ask(batches: DataFrame, question: Callable[[Batch], pa.Table]) -> DataFrame:
    """The questions of every batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch in batches_of(part):
                yield from question(batch).to_batches()
        release()

    return batches.mapInArrow(run, QUESTION)


def answer(questions: DataFrame, judge: Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]], kind: type) -> DataFrame:
    """``judge`` gets the keys and notes that the batches sent to a range, and returns a byte for each key."""

    def reply(table: pa.Table) -> pa.Table:
        keys = [unplanes(k, kind) for k in table.column("keys").to_pylist()]
        notes = [np.frombuffer(k, np.uint8) for k in table.column("notes").to_pylist()]
        out = [a.astype(np.uint8).tobytes() for a in judge(keys, notes)]
        del keys, notes
        release()
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "answer": pa.array(out, pa.binary())})

    return questions.groupBy("bucket").applyInArrow(reply, ANSWER)


def with_answers(batches: DataFrame, rounds: list[DataFrame], use: Callable[[Batch, list, list[np.ndarray]], pa.Table], schema: T.StructType | str) -> DataFrame:
    """``use`` gets a batch, its rows' other columns and for each round the answers in the order of its sorted fingerprints."""
    back, n_rounds = None, len(rounds)
    for k, answered in enumerate(rounds):
        part = answered.select("batch", F.lit(k).alias("round"), "bucket", "answer")
        back = part if back is None else back.unionByName(part)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (batch,) = batches_of(left)
        rest = left.column("rest").combine_chunks()
        rest = rest.chunk(0) if isinstance(rest, pa.ChunkedArray) else rest
        told: list[list[tuple[int, bytes]]] = [[] for _ in range(n_rounds)]
        for k, b, a in zip(*(right.column(c).to_pylist() for c in ("round", "bucket", "answer")), strict=True):
            told[k].append((b, a))
        used = use(batch, rest.flatten(), [np.frombuffer(b"".join(a for _, a in sorted(x)), np.uint8) for x in told])
        del batch, told
        release()
        return used

    return batches.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(run, schema)


def pick(batches: DataFrame, chosen: DataFrame, text: str) -> DataFrame:
    """The rows of the corpus, with their texts, whose numbers are in ``chosen.row``."""
    rest = batches.schema["rest"].dataType.elementType
    schema = T.StructType([*rest.fields, T.StructField(text, T.StringType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (batch,) = batches_of(left)
        at = np.sort(right.column("row").to_numpy() - batch.number * BATCH_ROWS)
        others = left.column("rest").combine_chunks()
        others = (others.chunk(0) if isinstance(others, pa.ChunkedArray) else others).flatten().take(pa.array(at))
        texts = pa.array([None if batch.null[i] else batch.text(i) for i in at], pa.binary()).cast(pa.string())
        return pa.Table.from_arrays([*(others.field(f.name) for f in rest), texts], names=schema.names)

    wanted = chosen.select(F.floor(F.col("row") / BATCH_ROWS).alias("batch"), "row")
    return batches.groupBy("batch").cogroup(wanted.groupBy("batch")).applyInArrow(run, schema)
