from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import planned, rows
from tickloom.operators import profiles as P
from tickloom.operators import quality as Q
from tickloom.session import freeze


def table(spark, values):
    return spark.createDataFrame([(i % 7, float(v) if v is not None else None, float(i)) for i, v in enumerate(values)], "day int, volume double, close double")


@pytest.mark.parametrize("seed", (0, 3))
def test_outliers_of_profiles_equal_those_of_the_bars(spark, seed):
    r = random.Random(seed)
    values = [r.choice([None, 0.0, r.gauss(0, 1), r.gauss(-3, 5), r.lognormvariate(0, 2), 1e9 + r.gauss(0, 1) if seed == 3 else 40.0]) for _ in range(3000)]
    bars = table(spark, values)
    loads = [P.value_profile(bars.where(F.col("day") == d), "day", ("volume", "close")) for d in range(7)]
    profile = loads[0]
    for load in loads[1:]:
        profile = profile.unionByName(load)
    profile, bars = freeze(profile), freeze(bars)
    for sigmas in (0.5, 2.0, 3.0):
        expected = rows(Q.outliers(bars, ("volume", "close"), sigmas))
        assert rows(P.outliers_from_profile(profile, bars, "day", ("volume", "close"), sigmas)) == expected


def test_values_beyond_a_bound_in_a_part_without_open_buckets_count_once(spark):
    # One bucket holds both: day 0 has the bound within its values, day 1 lies beyond it as a whole.
    values = [0.0] * 700
    values[0], values[7], values[1] = 100.0, 101.0, 100.9
    bars = table(spark, values)
    profile, bars = freeze(P.value_profile(bars, "day", ("volume",))), freeze(bars)
    for sigmas in (10.0, 15.24, 15.3, 16.0):
        assert rows(P.outliers_from_profile(profile, bars, "day", ("volume",), sigmas)) == rows(Q.outliers(bars, ("volume",), sigmas))


def test_no_bar_is_read_where_no_bucket_is_open(spark, tmp_path):
    bars = table(spark, [1.0, 2.0] * 500 + [1000.0])
    bars.write.partitionBy("day").parquet(str(tmp_path / "t"))
    stored = spark.read.schema("volume double, close double, day int").parquet(str(tmp_path / "t"))
    closed = P.outliers_from_profile(P.value_profile(bars, "day", ("volume",)), stored, "day", ("volume",))
    assert rows(closed) == [(1,)] and "FileScan" not in planned(closed)
    half = [8.0 if i % 7 == 2 else 1.0 for i in range(700)]
    half[2], half[9], half[16] = 8.2, 8.1, 7.0
    wide = table(spark, half)
    wide.write.partitionBy("day").parquet(str(tmp_path / "w"))
    stored = spark.read.schema("volume double, close double, day int").parquet(str(tmp_path / "w"))
    sigmas = (8.05 - float(wide.agg(F.avg("volume")).first()[0])) / float(wide.agg(F.stddev_samp("volume")).first()[0])
    found = P.outliers_from_profile(P.value_profile(wide, "day", ("volume",)), stored, "day", ("volume",), sigmas)
    assert rows(found) == rows(Q.outliers(wide, ("volume",), sigmas)) == [(2,)]
    plan = planned(found)
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1].split("]")[0] and "GreaterThan(volume" in plan


def test_nothing_one_value_and_missing_values(spark):
    for values in ([], [None, None], [0.1], [0.1] * 30, [float(2**60)] * 5):
        bars = table(spark, values)
        assert rows(P.outliers_from_profile(P.value_profile(bars, "day", ("volume",)), bars, "day", ("volume",))) == [(0,)]


def test_buckets_follow_the_order_of_values(spark):
    values = [-1e300, -3.0, -1.0, -1e-300, 0.0, 5e-324, 1e-300, 0.5, 0.99, 1.0, 1.05, 2.0, 1e300]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", P._bucket(F.col("v")).alias("b")).collect()
    same = [r.b for r in got if r.v >= 0]
    assert same == sorted(same) and all(r.b < 0 for r in got if r.v < 0) and sorted((r.b for r in got if r.v < 0)) == [r.b for r in got if r.v < 0]


def test_a_part_without_a_name_counts(spark):
    bars = spark.createDataFrame([(None if i % 2 else 1, float(i), 1.0) for i in range(100)], "day int, volume double, close double")
    found = P.outliers_from_profile(P.value_profile(bars, "day", ("volume",)), bars, "day", ("volume",), 1.0)
    assert rows(found) == rows(Q.outliers(bars, ("volume",), 1.0))
