"""Looking back within keys that may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def previous_row(
    df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], chunk: Column, prefix: str = "prev_"
) -> DataFrame:
    """Add the values of the key's previous row, as LAG would.

    A LAG over the key alone sends a key to one task, which fails for raw
    ticks, where one symbol may hold a third of everything.  Here a key is cut
    into chunks (``chunk`` must not decrease along ``order``) and LAG runs in
    a chunk.  The first row of a chunk also learns the chunk's last values and
    is set aside: among these rows, one per key and chunk, a second LAG hands
    the last values on to the next chunk.
    """
    inside = W.partitionBy(key, "_chunk").orderBy(*order)
    whole = inside.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = df.withColumn("_chunk", chunk).withColumns(
        {f"{prefix}{v}": F.lag(v).over(inside) for v in values}
        | {f"_last_{v}": F.last(v).over(whole) for v in values}
        | {"_number": F.row_number().over(inside)}
    )
    output = [*df.columns, *[f"{prefix}{v}" for v in values]]
    later = rows.where(F.col("_number") > 1).select(*output)
    first = (
        rows.where(F.col("_number") == 1)
        .withColumns({f"{prefix}{v}": F.lag(f"_last_{v}").over(W.partitionBy(key).orderBy("_chunk")) for v in values})
        .select(*output)
    )
    return later.unionByName(first)


def numbered_rows(df: DataFrame, key: str, order: list[str], chunk: Column) -> DataFrame:
    """``df`` with ``row_number``, from 1 by key and order; ``chunk`` must not fall as the order rises.

    Rows are numbered within (key, chunk) and shifted by the counts of the chunks before, so a key that
    holds a third of all rows is spread over its chunks.
    """
    cut = df.withColumn("_chunk", chunk)
    within = cut.withColumn("_within", F.row_number().over(W.partitionBy(key, "_chunk").orderBy(*order)))
    counts = cut.groupBy(key, "_chunk").agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(key, "_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return within.join(shifts, [key, "_chunk"]).withColumn("row_number", F.col("_within") + F.col("_before")).drop("_chunk", "_within", "_before")


def over_last_rows(df: DataFrame, key: str, order: list[str], chunk: Column, n: int, aggregates: dict[str, Callable[[W], Column]], block: int = 100_000) -> DataFrame:
    """``df`` with aggregates over each row and the n - 1 rows of its key before it.

    Numbered rows are dealt to blocks of bounded length; the last n - 1 rows of a block are also
    dealt to the next one, where they are looked at only.
    """
    size = max(block, n)
    here = F.floor((F.col("row_number") - 1) / size)
    lent = F.when(F.pmod(F.col("row_number") - 1, F.lit(size)) >= size - (n - 1), F.array(here, here + 1)).otherwise(F.array(here))
    dealt = numbered_rows(df, key, order, chunk).withColumn("_home", here).withColumn("_block", F.explode(lent))
    frame = W.partitionBy(key, "_block").orderBy("row_number").rowsBetween(-(n - 1), W.currentRow)
    out = dealt.select("*", *[build(frame).alias(name) for name, build in aggregates.items()])
    return out.where("_block = _home").select(*df.columns, *aggregates)
