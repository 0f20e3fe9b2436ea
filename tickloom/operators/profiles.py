"""Outliers from stored profiles of loads, without reading the bars again.

A profile holds one row per part of the table (a day, a month), field and bucket of values: how many
there are, the smallest, the largest, their mean and squared deviations.  Buckets are
a sixteenth of a doubling wide, so a part has a few hundred rows however many bars
it has, and profiles of loads are simply appended.  Moments of all bars, and with them the bounds beyond
which a value is an outlier, come from the profiles; so do the numbers of outliers in all buckets but those
that a bound goes through.  Only the bars of these buckets are looked at, in the parts that have any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.operators.quality import PRICES

#: Buckets to a doubling of the value.
_FINENESS = 16
_FIELDS = ("volume", *PRICES)


def _bucket(value: Column) -> Column:
    """Number of a value's bucket; it grows with the value's size, and its sign is the value's, beside zero's own bucket."""
    # Exponents of doubles lie above -1075, so what is added keeps the number positive.
    size = F.floor(F.log2(F.abs(value)) * _FINENESS) + 1100 * _FINENESS
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * size).cast("int")


def value_profile(bars: DataFrame, part: str, fields: Sequence[str] = _FIELDS) -> DataFrame:
    """``part``, ``field``, ``bucket``, ``n``, ``low``, ``high``, ``mean``, ``squares`` (sum of squared deviations) of the values of a load.

    One pass, combined in the map tasks.  Missing values count nowhere; a field without values has no row.
    """
    values = bars.select(F.col(f"`{part}`").alias("part"), *[F.col(f"`{f}`").cast("double").alias(f) for f in fields])
    long = values.unpivot(["part"], list(fields), "field", "value").where("value IS NOT NULL")
    return long.groupBy("part", "field", _bucket(F.col("value")).alias("bucket")).agg(
        F.count("*").alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("*")).alias("squares"),
    )


def bounds_of(profile: DataFrame, sigmas: float = K.OUTLIER_SIGMAS) -> DataFrame:
    """``field``, ``n``, ``mean``, ``deviation`` (of a sample), ``least`` and ``most`` (values beyond are outliers), one row a field.

    A field with a single value in all its rows has no bounds, so rounding makes no outliers of it; neither has one with a single row.
    """
    # Deviations are taken around a mean near the true one first, so large values of little spread lose nothing.
    centre = profile.groupBy("field").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    around = profile.join(centre, "field").withColumn("off", F.col("mean") - F.col("centre"))
    n, shift = F.sum("n"), F.sum(F.col("n") * F.col("off")) / F.sum("n")
    squares = F.sum(F.col("squares") + F.col("n") * F.col("off") * F.col("off")) - n * shift * shift
    found = around.groupBy("field").agg(
        n.alias("n"),
        (F.first("centre") + shift).alias("mean"),
        F.when((n > 1) & (F.min("low") < F.max("high")), F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))).alias("deviation"),
    )
    reach = F.col("deviation") * sigmas
    return found.withColumn("least", F.col("mean") - reach).withColumn("most", F.col("mean") + reach)


def outliers_from_profile(profile: DataFrame, bars: DataFrame, part: str, fields: Sequence[str] = _FIELDS, sigmas: float = K.OUTLIER_SIGMAS) -> DataFrame:
    """One row with the number of outliers of every field, as ``quality.outliers`` has it, from the profiles of all loads.

    ``bars`` is the stored table that the profiles are of.  A bucket of a part is open if a bound goes through its values.  What reaches the
    driver is a row a field: its bounds, the outliers in buckets that are not open, the range of values in open ones, and the first and the last part with one.
    The scan sees the ranges and the parts as literals, and no bar is read where no bucket is open.
    """
    held = profile.join(bounds_of(profile, sigmas).select("field", "least", "most"), "field")
    outside = (F.col("low") > F.col("most")) | (F.col("high") < F.col("least"))
    above = (F.col("low") <= F.col("most")) & (F.col("high") > F.col("most"))
    below = (F.col("low") < F.col("least")) & (F.col("high") >= F.col("least"))
    # One bucket holds a bound, so what a part has in other buckets lies out of that bucket's range.
    ranges = [
        f(F.when(which, F.col(c))).alias(f"{name}_{end}")
        for name, which in (("above", above), ("below", below))
        for end, f, c in (("from", F.min, "low"), ("to", F.max, "high"))
    ]
    facts = held.groupBy("field").agg(
        F.first("least").alias("least"),
        F.first("most").alias("most"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("sure"),
        F.min(F.when(above | below, F.col("part"))).alias("first_part"),
        F.max(F.when(above | below, F.col("part"))).alias("last_part"),
        *ranges,
    )
    known = {r["field"]: r for r in facts.collect()}
    sure = {f: known[f]["sure"] if f in known else 0 for f in fields}
    flags, counts, looked_at = [], [], F.lit(False)
    for f in fields:
        for name, which, beyond in (("above", above, "most"), ("below", below, "least")):
            r = known.get(f)
            if r is None or r[f"{name}_from"] is None:
                continue
            value = F.col(f"`{f}`").cast("double")
            past = value > r[beyond] if name == "above" else value < r[beyond]
            inside = past & value.between(r[f"{name}_from"], r[f"{name}_to"])
            # A missing part has no order.
            near = F.col(f"`{part}`").isNull() if r["first_part"] is None else F.col(f"`{part}`").between(r["first_part"], r["last_part"]) | F.col(f"`{part}`").isNull()
            looked_at |= near & inside
            flags.append(F.max((F.col("field") == f) & which).alias(f"flag {len(flags)}"))
            counts.append((f, inside.alias(f"inside {len(counts)}")))
    if not counts:
        return profile.sparkSession.range(1).select(*[F.lit(sure[f]).cast("bigint").alias(f"{f}_outliers") for f in fields])
    open_parts = held.where(above | below).groupBy("part").agg(*flags)
    rows = bars.where(looked_at).select(F.col(f"`{part}`").alias("part of bars"), *[c for _, c in counts])
    both = rows.join(open_parts, F.col("part of bars").eqNullSafe(F.col("part")))
    found = {f: F.lit(sure[f]) for f in fields}
    for i, (f, _) in enumerate(counts):
        found[f] += F.count_if(F.col(f"inside {i}") & F.col(f"flag {i}"))
    return both.agg(*[found[f].cast("bigint").alias(f"{f}_outliers") for f in fields])
