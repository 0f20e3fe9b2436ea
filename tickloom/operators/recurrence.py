"""Linear recurrences (exponential averages) in closed form.

``y[r] = (1 - alpha) * y[r-1] + alpha * x[r]`` maps the value before a stretch of rows
to the value after it by an affine map ``y -> a * y + b``: ``a`` is the decay to the
power of the stretch's length, ``b`` a weighted running sum of its inputs.  Such maps compose, so a
series may be cut anywhere.  It is cut twice.  Within one load, ``decay^-i`` would overflow on
long series, so running sums restart every ``block`` rows, and a block begins with the
composition of the maps of all blocks before it.  Between loads, the values after the last row
are stored, one row per key (``next_state``), and the next load goes on from them: appending
a day reads that day's rows and the states, not the history.

Running sums are ordinary windows, so the whole chain stays in the JVM and
shares the one shuffle by key.  Rows are sorted twice, as narrow as they come, in tasks as many
as the input asks for (``session.gathered``): to number them and by block.  All
averages of a chain keep the second order, as does a state, which is a row before those of its key.  The sums run over differences from the seed value (or from the stored one), to
which the recurrence is indifferent: a constant series then averages to exactly itself, and the seed
row to exactly the seed, as they do when the recurrence is stepped through.
A missing input leaves no value from its row on, as in the recurrence.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.session import gathered

# exp(650) stays clear of the largest double with room for the values.
_MAX_EXPONENT = 650.0


@dataclass(frozen=True)
class Smoothing:
    """One exponential average: its input, span, seed row and output column."""

    value: str
    span: int
    seed_row: int
    output: str

    @property
    def alpha(self) -> float:
        return 2.0 / (self.span + 1)

    @property
    def decay(self) -> float:
        return 1.0 - self.alpha


def block_size(smoothings: list[Smoothing]) -> int:
    """Rows of a block within which no weight of these averages overflows."""
    if any(s.span < 2 for s in smoothings):
        raise ValueError("a span must be at least 2")
    return int(_MAX_EXPONENT / -math.log(min(s.decay for s in smoothings)))


def numbered(df: DataFrame, key: str, order: str, row_number: str, state: DataFrame | None = None) -> DataFrame:
    """``df`` with a ``row_number`` that counts the rows of a key from 1.

    A ``state`` (see ``next_state``) puts a row numbered 0, with all it holds in ``_state``, before those of its key.
    """
    by_key = W.partitionBy(key)
    if state is None:
        return gathered(df, key).withColumn(row_number, F.row_number().over(by_key.orderBy(order)))
    before = state.where(F.col(key).isNotNull()).select(key, F.struct(*[c for c in state.columns if c != key]).alias("_state"))
    both = gathered(df.unionByName(before, allowMissingColumns=True), key).withColumn("_new", F.col("_state").isNull())
    so_far = by_key.orderBy("_new", order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.withColumn(row_number, F.count_if("_new").over(so_far)).drop("_new")


def in_blocks(df: DataFrame, key: str, order: str, row_number: str, block: int) -> DataFrame:
    """Numbered rows sorted by key, ``_block`` and order, and the number of rows ``_seen`` before them."""
    cut = df.withColumn("_block", F.floor((F.col(row_number) - 1) / block)).sortWithinPartitions(key, "_block", order)
    if "_state" not in df.columns:
        return cut.withColumn("_seen", F.lit(0).cast("long"))
    return cut.withColumn("_seen", F.coalesce(F.max("_state.rows").over(by_block(key, order).rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0)))


def by_block(key: str, order: str) -> WindowSpec:
    """The rows of a key in order, as they are sorted already."""
    return W.partitionBy(key).orderBy("_block", order)


def exponential_averages(df: DataFrame, key: str, order: str, smoothings: list[Smoothing], row_number: str, block: int | None = None) -> DataFrame:
    """Add one column per smoothing; rows before a seed row get NULL, and so do
    all rows from the first missing input after it on.

    ``row_number`` names a column that counts the rows of a key from 1.  Rows that follow a state (see
    ``numbered``) go on from it; seed rows count from the first row that it has seen.  All smoothings share one
    pass over the sorted rows; those of a chain share blocks, if its first call gets them ``in_blocks``.
    """
    size = block or block_size(smoothings)
    if "_block" in df.columns:
        return _averages_in_blocks(df, df.columns, key, order, smoothings, row_number, size)
    return _averages_in_blocks(in_blocks(df, key, order, row_number, size), df.columns, key, order, smoothings, row_number, size)


def next_state(averaged: DataFrame, key: str, smoothings: list[Smoothing], row_number: str, state: DataFrame | None = None) -> DataFrame:
    """``key``, ``rows`` seen so far and the last value of each smoothing, after the rows of ``averaged``.

    A smoothing past its seed row without a value has met a missing input and stays without one.
    ``state`` is what ``averaged`` went on from; keys without new rows keep theirs.
    """
    last = averaged.groupBy(key).agg(
        F.max(row_number).cast("long").alias("rows"), *[F.max_by(s.output, row_number).alias(s.output) for s in smoothings]
    )
    if state is None:
        return last
    before = state.select(key, F.col("rows").alias("before"), *[F.col(s.output).alias(f"before_{s.output}") for s in smoothings])
    both = before.join(last, key, "full")
    return both.select(
        key,
        (F.coalesce("before", F.lit(0)) + F.coalesce("rows", F.lit(0))).alias("rows"),
        *[F.when(F.col("rows").isNull(), F.col(f"before_{s.output}")).otherwise(F.col(s.output)).alias(s.output) for s in smoothings],
    )


def _after(power: float) -> Callable[[Column, Column], Column]:
    """The map of a block of this decay, applied to the value before it."""
    return lambda y, b: y * F.lit(power) + b


def _averages_in_blocks(
    df: DataFrame, columns: list[str], key: str, order: str, smoothings: list[Smoothing], row_number: str, block: int
) -> DataFrame:
    here = F.col(row_number)
    rn = here + F.col("_seen")
    by_key = by_block(key, order)
    so_far = by_key.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Averages of one input and seed row share what they begin with.
    starts = list(dict.fromkeys((s.value, s.seed_row) for s in smoothings))
    at = [starts.index((s.value, s.seed_row)) for s in smoothings]
    first = {}
    for i, (value, seed_row) in enumerate(starts):
        first[f"_seed{i}"] = F.last(F.when(rn == seed_row, F.col(value)), ignorenulls=True).over(so_far)
        first[f"_gaps{i}"] = F.count(F.when((here > 0) & (rn >= seed_row) & F.col(value).isNull(), 1)).over(so_far)
    out = df.withColumns(first).withColumn("_pos", F.pmod(here - 1, F.lit(block)))
    if "_state" in df.columns:
        out = out.withColumns({f"_from{i}": F.first(F.col(f"_state.{s.output}"), ignorenulls=True).over(so_far) for i, s in enumerate(smoothings)})
    else:
        out = out.withColumns({f"_from{i}": F.lit(None).cast("double") for i in range(len(smoothings))})
    out = out.withColumns({f"_base{i}": F.coalesce(f"_from{i}", f"_seed{at[i]}") for i in range(len(smoothings))})

    # The windows below are ordered by key, block and order column too.
    in_block = W.partitionBy(key, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = by_key.rowsBetween(W.unboundedPreceding, -1)
    weighted = {}
    for i, s in enumerate(smoothings):
        moved = F.col(s.value) - F.col(f"_base{i}")
        # The seed row itself differs from the seed by nothing.
        share = F.when(F.col(f"_from{i}").isNull() & (rn <= s.seed_row), F.lit(0.0)).otherwise(moved * s.alpha)
        scaled = share * F.pow(F.lit(1.0 / s.decay), F.col("_pos"))
        weighted[f"_within{i}"] = F.sum(scaled).over(in_block) * F.pow(F.lit(s.decay), F.col("_pos"))
    out = out.withColumns(weighted)

    # What earlier blocks leave: their maps, composed in order from no difference on.  A key has few blocks.
    at_end = (here > 0) & (F.col("_pos") == block - 1)
    ends = {
        f"_ends{i}": F.collect_list(F.when(at_end, F.coalesce(f"_within{i}", F.lit(0.0)))).over(before) for i in range(len(smoothings))
    }
    out = out.withColumns(ends)
    results = []
    for i, s in enumerate(smoothings):
        left = F.aggregate(f"_ends{i}", F.lit(0.0), _after(s.decay**block))
        value = F.col(f"_base{i}") + F.col(f"_within{i}") + left * F.pow(F.lit(s.decay), F.col("_pos") + 1)
        broken = (F.col(f"_gaps{at[i]}") > 0) | (F.col(f"_from{i}").isNull() & (F.col("_seen") >= s.seed_row))
        results.append(F.when((rn >= s.seed_row) & ~broken, value).alias(s.output))
    return out.select(*columns, *results)
