"""Texts judged one by one in slices of bounded size, beside the rows' other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.corpus import release

#: Bytes of text and rows judged at a time; a longer text is a slice of its own.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 4096


def slices(texts: pa.Array, most_bytes: int, most_rows: int) -> Iterator[tuple[int, int]]:
    """Begin and number of rows of each slice."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        take = min(max(1, int(np.searchsorted(ends, before + most_bytes, "right")) - at), most_rows)
        yield at, take
        at += take


def judge_texts(df: DataFrame, text: str, results: T.StructType, judge: Callable[[list], list[pa.Array]], binary: bool = True, keep_text: bool = False) -> DataFrame:
    """All columns of ``df`` but the text, and what ``judge`` makes of a slice of texts (``bytes`` or ``str``, None where null).

    A result replaces a column of its name; other columns pass through as one struct, so no name can clash.
    """
    others = [f for f in df.schema.fields if f.name not in results.names and (keep_text or f.name != text)]
    rest = F.struct(*[F.col(f"`{f.name}`") for f in others]) if others else F.struct(F.lit(None).cast("int").alias("nothing"))
    packed = df.select(rest.alias("rest"), F.col(f"`{text}`").cast("string").cast("binary" if binary else "string").alias("text"))
    kinds = [results, packed.schema["rest"].dataType]
    schema = T.StructType([T.StructField("results", kinds[0]), T.StructField("rest", kinds[1])])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, take in slices(part.column("text"), SLICE_BYTES, SLICE_ROWS):
                some = part.slice(at, take)
                found = pa.StructArray.from_arrays(judge(some.column("text").to_pylist()), names=results.names)
                yield pa.RecordBatch.from_arrays([found, some.column("rest")], names=["results", "rest"])
        release()

    judged = packed.mapInArrow(run, schema)
    return judged.select(*[F.col("rest")[f.name].alias(f.name) for f in others], *[F.col("results")[n].alias(n) for n in results.names])
