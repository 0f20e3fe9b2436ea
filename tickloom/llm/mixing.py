"""Mixing of sources to target weights by hash-threshold histograms.

Each source's share of the budget is filled with whole copies of all its rows as
often as they fit, and the rest of the share with the rows whose hash is below a
threshold.  Thresholds come from histograms: words by source and by the leading
bits of the hash; the bucket in which a budget ends is refined by the next bits,
alone, until it holds one hash value.  A larger budget has a larger threshold,
so its mix holds that of any smaller one.  Rows with the hash at which a budget ends, repeated rows, are
counted off.  No row is sorted, and none passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import Scratch

WEIGHTS = (3.0, 1.0, 2.0)
#: Hashes have this many bits, looked at so many at a time.
HASH_BITS, LEVEL_BITS = 60, 10


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(key: str, text: str) -> Column:
    """60 bits from key and text; nulls and empty texts have values of their own."""
    both = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(" "), F.coalesce(F.md5(F.col(text)), F.lit("null")))
    return F.conv(F.substring(F.md5(both), 1, HASH_BITS // 4), 16, 10).cast("long")


def _sums_before(scratch: Scratch, rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with sums over all rows before each in a total order.

    Rows are range-partitioned and summed up within ranges; only totals, a row per range, pass through one task.
    """
    # Range borders are sampled: stored, so rows and totals see the same.
    ranged = scratch.keep(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select("*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{n} inside") for n, c in sums.items()])
    totals = ranged.groupBy("range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("range", *[F.coalesce(F.sum(n).over(across), F.lit(0)).alias(f"{n} offset") for n in sums])
    return inside.join(offsets, "range").select(*rows.columns, *[(F.col(f"{n} inside") + F.col(f"{n} offset")).alias(n) for n in sums])


def targets(scratch: Scratch, totals: DataFrame, budget_percent: int, cap: int, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Targets of the sources, from ``source`` and ``source_size``.

    Weights repeat over the sources by code point, null last.  All have a common level per weight, but where
    that is above ``cap`` times a source's size it stops there, which is what resharing the excess until none is
    above ends in: by size for its weight, sources are capped while the level that the rest would get is no less.
    Sources may be as many as rows, so they are numbered and summed up in ranges.
    """
    by_source = [F.col("source").isNull().asc(), F.col("source").asc()]
    numbered = _sums_before(scratch, totals, by_source, {"number": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    placed = numbered.withColumn("weight", weight).drop("number").withColumn("limit", F.col("source_size") * float(cap))
    placed = placed.withColumn("ratio", F.col("limit") / F.col("weight"))
    placed = _sums_before(scratch, placed, [F.col("ratio").asc(), *by_source], {"limit_before": F.col("limit"), "weight_before": F.col("weight")})
    placed = scratch.keep(placed, "placed")
    budget = placed.select(F.sum("source_size")).scalar() * float(budget_percent) / 100.0
    left = budget - F.col("limit_before")
    weight_left = placed.select(F.sum("weight")).scalar() - F.col("weight_before")
    levels = placed.withColumn("level", left / weight_left)
    # The first source whose limit is above the level sets the level of all after it.
    first = levels.select(F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level")))["level"]).scalar()
    found = levels.withColumn("common", first)
    return found.select("source", "source_size", F.coalesce(F.least("limit", F.col("common") * F.col("weight")), F.col("limit")).alias("target"))


def _thresholds(scratch: Scratch, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each source (by number) the hash below which rows get one copy more, and how many of the ``tied`` rows with
    just this hash do: as many as come nearest to the budget's end, the fewer if both are as near.
    """
    done = None
    open_ = wanted.select("number", F.col("extra").alias("left"), F.lit(0).cast("long").alias("prefix"))
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        bits = HASH_BITS - level * LEVEL_BITS
        inside = rows.join(open_.select("number"), "number", "left_semi") if level == 1 else rows.join(open_.select("number", "prefix"), "number").where(F.shiftright("hash", bits + LEVEL_BITS) == F.col("prefix"))
        sums = inside.groupBy("number", F.shiftright("hash", bits).alias("bucket")).agg(F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.count("*").alias("n"))
        by = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        run = sums.withColumn("upto", F.sum("size").over(by)).join(open_, "number")
        # The bucket where the budget ends; a budget beyond all rows ends after the last.
        ends = run.where("upto > left").groupBy("number").agg(F.min_by(F.struct("bucket", "size", "upto", "left", "low", "high", "n"), "bucket").alias("at")).select("number", "at.*")
        ends = scratch.keep(ends, "ends")
        # Rows equal in hash are equal in size: the n rows weigh size together.
        rows_left = (F.col("left") - (F.col("upto") - F.col("size"))) * F.col("n") / F.col("size")
        single = ends.where("low = high").select("number", F.col("low").alias("threshold"), F.ceil(rows_left - 0.5).cast("long").alias("tied"))
        done = single if done is None else done.unionByName(single)
        open_ = ends.where("low < high").select("number", (F.col("left") - (F.col("upto") - F.col("size"))).alias("left"), F.col("bucket").alias("prefix"))
        if open_.isEmpty():
            break
    return done


#: Tied rows numbered in one task.
TIED_ROWS = 1 << 16


def _with_copies(scratch: Scratch, rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with ``hash`` and ``number``) and the plan, with ``copies``.

    Tied rows are stored and numbered by where they lie, in stretches of bounded length, then stretch by stretch, so a
    row that is a third of all is no burden to one task.  As they are equal in key and text, it is all one which of them are taken.
    """
    met = rows.join(plan, "number")
    is_tied = F.coalesce(F.col("hash") == F.col("threshold"), F.lit(False))
    clear = met.where(~is_tied).withColumn("copies", F.col("whole") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0))
    tied = scratch.keep(met.where(is_tied).withColumn("place", F.monotonically_increasing_id()), "tied")
    tied = tied.withColumn("stretch", F.floor(F.col("place") / TIED_ROWS))
    counts = tied.groupBy("number", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("number", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("number", "stretch").orderBy("place"))
    numbered = tied.withColumn("inside", inside).join(offsets, ["number", "stretch"])
    decided = numbered.withColumn("copies", F.col("whole") + F.when(F.col("earlier") + F.col("inside") <= F.col("tied"), 1).otherwise(0))
    return clear.unionByName(decided.select(*clear.columns))


def _number(source: str) -> Column:
    return F.xxhash64(F.col(source).isNull(), F.col(source))


def plan_mix(
    scratch: Scratch, df: DataFrame, key: str, text: str, source: str, budget_percent: int, cap: int, weights: tuple[float, ...]
) -> tuple[DataFrame, DataFrame]:
    """Stored sizes and hashes of the rows, and the plan: a row per source with its number, size, target, whole copies, and the threshold for one more."""
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), word_count(f"`{text}`").alias("size"), row_hash(f"`{key}`", f"`{text}`").alias("hash")
    )
    rows = scratch.keep(rows.withColumn("number", _number("source")), "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(scratch, totals, budget_percent, cap, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = scratch.keep(plan.withColumn("number", _number("source")), "targets")
    thresholds = _thresholds(scratch, rows, plan.where("extra > 0"))
    decided = plan.join(thresholds, "number", "left").select("number", "source_size", "target", "whole", "threshold", "tied")
    return rows, scratch.keep(decided, "plan")


def mix_sources(
    scratch: Scratch,
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget_percent: int = 150,
    cap: int = 2,
    weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """How often the mix takes each row.

    Returns a row per row of ``df``: the key column, ``source``, ``size`` (words; null texts: 0), ``source_size``,
    ``target``, ``copies`` and ``taken`` (words, copies counted).  Rows without words are taken as their hash
    says and weigh nothing.  A null source is a source.  Of rows equal in key and text
    as many are taken once more as come nearest to the target.  Empty tables give empty results.  Other columns take no part.
    """
    rows, plan = plan_mix(scratch, df, key, text, source, budget_percent, cap, weights)
    taken = _with_copies(scratch, rows, plan)
    return taken.select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_rows(
    scratch: Scratch,
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget_percent: int = 150,
    cap: int = 2,
    weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, in the columns of ``df``.

    As in ``mix_sources``; where rows equal in key and text differ in other columns, which of them a mix takes that takes some is not stated.
    """
    _, plan = plan_mix(scratch, df, key, text, source, budget_percent, cap, weights)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole_row")
    hashed = df.select(whole, row_hash(f"`{key}`", f"`{text}`").alias("hash"), _number(f"`{source}`").alias("number"))
    copies = _with_copies(scratch, hashed, plan).where("copies > 0")
    repeated = copies.select("whole_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select("whole_row.*")
