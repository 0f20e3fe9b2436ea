"""Global ranks without a single-task sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.session import freeze


def global_rank(df: DataFrame, score: Column, output: str, within: list[str] | None = None) -> DataFrame:
    """RANK by a score, largest first and NULL before everything.

    A window without partitions would sort the whole table in one task, and so
    would a category that holds most rows.  Here rows are first counted per
    distinct score; the counts are range-partitioned by score, each range sums
    up its own counts, and the totals of the ranges (one row per range) give
    the offsets.  Only counts are sorted, and a score shared by many rows is
    one count.
    """
    within = within or []
    scored = df.withColumn("_score", score)
    counts = scored.groupBy(*within, "_score").agg(F.count("*").alias("_n"))
    order = [F.col(c).asc() for c in within] + [F.col("_score").desc_nulls_first()]
    # Range borders are sampled: fix them, so offsets and rows see the same.
    ranges = freeze(counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))

    in_range = W.partitionBy("_range", *within).orderBy(F.col("_score").desc_nulls_first())
    inside = ranges.withColumn(
        "_above", F.coalesce(F.sum("_n").over(in_range.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    totals = ranges.groupBy("_range", *within).agg(F.sum("_n").alias("_total"))
    across = W.partitionBy(*(within or [F.lit(0)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(across), F.lit(0))).drop("_total")
    def same(left: str, right: str, columns: list[str]) -> Column:
        """Equality that holds between missing values too."""
        return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])

    ranks = inside.alias("i").join(offsets.alias("o"), same("i", "o", ["_range", *within])).select(
        *[F.col(f"i.{c}").alias(c) for c in within],
        F.col("i._score").alias("_score"),
        (F.col("i._above") + F.col("o._offset") + 1).alias(output),
    )
    matched = scored.alias("rows").join(ranks.alias("ranks"), same("rows", "ranks", [*within, "_score"]))
    return matched.select("rows.*", f"ranks.{output}").drop("_score")
