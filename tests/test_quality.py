from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import BAR_SCHEMA, bars, column, day, executed_plan, rows
from tickloom.operators import quality as Q
from tickloom.operators import validation as V
from tickloom.operators.chunked import previous_row
from tickloom.workload.queries import QUERIES


def dirty(spark):
    return spark.createDataFrame(
        [
            ("A", day(0), 5.0, 6.0, 4.0, 5.0, 100.0, 10),
            ("A", day(1), 7.0, 6.0, 4.0, 3.0, 0.0, 10),  # open above high, close below low, no volume
            ("A", day(1), 5.0, 3.0, 4.0, 5.0, 100.0, 0),  # high below low, no transactions
            ("B", None, 3.0, 6.0, 4.0, 7.0, 5.0, 10),  # open below low, close above high
            (None, day(3), -1.0, 6.0, None, 5.0, 100.0, None),
        ],
        BAR_SCHEMA,
    )


def test_counts(spark):
    assert Q.volume_checks(dirty(spark)).first().asDict() == {
        "total_records": 5, "invalid_volume": 1, "invalid_transactions": 1, "volume_less_than_transactions": 2,
    }
    assert Q.price_checks(dirty(spark)).first().asDict() == {
        "high_less_than_low": 1, "open_above_high": 2, "open_below_low": 1, "close_above_high": 2,
        "close_below_low": 1, "negative_prices": 1,
    }
    assert Q.null_percentages(dirty(spark), ["ticker", "low"]).first().asDict() == {
        "ticker_null_percentage": 20.0, "low_null_percentage": 20.0,
    }
    missing = {r.field: (r.missing, r.percentage) for r in Q.missing_values(dirty(spark)).collect()}
    assert missing["ticker"] == (1, 20.0) and missing["open"] == (0, 0.0)


def test_gate(spark):
    failed = column(Q.load_gate(dirty(spark)).where("not passed"), "check", "check")
    assert "Invalid transactions percentage" in failed and "Ticker null percentage" in failed
    assert "Volume null percentage" not in failed
    assert not Q.passes_load_gate(dirty(spark))
    clean = bars(spark, {"A": [5.0] * 3})
    assert Q.passes_load_gate(clean)
    assert Q.load_gate(clean).count() == 14
    assert not Q.passes_load_gate(clean.limit(0))


def test_out_of_order_by_arrival(spark):
    data = [("A", day(2), 1), ("A", day(1), 2), ("A", day(3), 3), ("B", day(0), 4), ("A", None, 5), ("A", day(0), 6)]
    df = spark.createDataFrame(data, "ticker string, date date, arrival bigint")
    for chunk in (1, 2, 100):
        # The row after a missing date has nothing to compare with.
        assert rows(Q.timestamp_checks(df, "arrival", chunk)) == [(1, 1)]


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_previous_row_equals_lag(spark, chunk):
    df = spark.range(200).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("key"),
        F.col("id").alias("at"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 2).alias("v"),
    )
    got = previous_row(df, "key", ["at"], ["at", "v"], F.floor(F.col("at") / chunk))
    by_key = Q.W.partitionBy("key").orderBy("at")
    expected = df.withColumns({"prev_at": F.lag("at").over(by_key), "prev_v": F.lag("v").over(by_key)})
    assert rows(got.select(expected.columns), "at") == rows(expected, "at")


def test_previous_row_shuffles_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select((F.col("id") % 3).alias("key"), F.col("id").alias("at"), F.col("id").alias("v")).write.parquet(path)
    got = previous_row(spark.read.parquet(path), "key", ["at"], ["v"], F.floor(F.col("at") / 10))
    plan = executed_plan(got).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_completeness(spark):
    df = bars(spark, {"A": [1.0] * 10, "B": [1.0] * 9, "C": [1.0] * 8})
    assert rows(Q.ticker_completeness(df)) == [(3, 1)]
    assert rows(Q.ticker_completeness(df, of_all_records=True)) == [(3, 3)]


def test_outliers(spark):
    df = bars(spark, {"A": [10.0] * 50 + [1000.0]})
    got = Q.outliers(df, ("close", "volume")).first()
    assert (got.close_outliers, got.volume_outliers) == (1, 0)


def test_rules(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, -3, "b")], "k int, v int, s string")
    assert Q.not_null(df, "s").count() == 1
    assert rows(Q.unique(df, "k")) == [(1, 2)]
    assert Q.unique(df, "k", "v").count() == 0
    assert rows(Q.accepted_values(df, "s", ["a"])) == [("b", 1)]
    assert Q.at_least(df, "v", "k").count() == 1
    assert rows(Q.is_positive(df, "v", "warn").select("v", "severity")) == [(-3, "warn")]
    assert column(Q.is_even(df, "k"), "v", "v") == [1, 2]
    assert column(Q.is_odd(df, "k"), "v", "v") == [-3]
    assert rows(Q.negative_totals(df, "k", "v")) == [(2, -3)]
    assert Q.value_length_between(df, "v", 2, 31).count() == 2
    arrays = spark.sql("SELECT array() AS a UNION ALL SELECT array(1)")
    assert Q.array_not_empty(arrays, "a").count() == 1


def test_calendar_is_filled_with_the_last_close(spark):
    df = bars(spark, {"A": [1.0, 2.0], "B": [9.0]}, [day(0), day(3)])
    assert rows(Q.fill_calendar(df), "ticker", "date") == [
        ("A", day(0), 1.0, False), ("A", day(1), 1.0, True), ("A", day(2), 1.0, True), ("A", day(3), 2.0, False),
        ("B", day(0), 9.0, False),
    ]


def test_price_jumps(spark):
    got = Q.price_jumps(bars(spark, {"A": [10.0, 16.0, 15.0, 7.0]}), 50.0)
    assert rows(got.select("date", "prev_close"), "date") == [(day(1), 10.0), (day(3), 15.0)]


def vendor(spark):
    return spark.createDataFrame(
        [("A", day(0), 10.04, 20.0), ("A", day(1), 10.2, None), ("B", day(1), 1.0, 1.0)],
        "ticker string, timestamp date, sma_10 double, sma_20 double",
    )


def test_indicator_errors(spark):
    ours = spark.createDataFrame(
        [("A", day(0), 10.0, 20.0), ("A", day(1), 10.0, 0.0)], "ticker string, date date, sma_10 double, sma_20 double"
    )
    errors = V.indicator_errors(vendor(spark), ours, "sma", (10, 20))
    got = rows(errors.select("ticker", "timestamp", F.round("sma_10_error_percent", 6), "sma_10_is_critical", "sma_20_is_critical"), "ticker", "timestamp")
    assert got == [("A", day(0), 0.4, False, False), ("A", day(1), 2.0, True, False), ("B", day(1), None, False, False)]
    strict = V.indicator_errors(vendor(spark), ours, "sma", (10, 20), threshold=0.1)
    assert rows(V.critical_counts(strict, "sma", (10, 20))) == [("A", 10, 2)]
    assert V.critical_counts(strict, "sma", (10, 20), by_day=True).count() == 2
    assert column(V.critical_yesterday(strict, "sma", (10, 20)), "timestamp", "timestamp") == [day(0)]


def test_vendor_consolidation(spark):
    ms = int(dt.datetime(2024, 1, 1, 5, tzinfo=dt.timezone.utc).timestamp() * 1000)
    data = [("A", 10, ms, 1.0), ("A", 10, ms + 1000, 2.0), ("A", 20, ms, 3.0), ("A", 20, 0, 9.0), ("A", 20, None, 9.0)]
    points = spark.createDataFrame(data, "ticker string, window int, timestamp bigint, value double")
    assert rows(V.consolidate_vendor(points, "sma", (10, 20, 50))) == [("A", day(0), 2.0, 3.0, None)]


@pytest.mark.parametrize("name", ["a17_critical_counts", "a17_critical_counts_by_day", "a19_sma_errors", "a19_ema_errors", "a19_wma_errors", "j7_vendor_join"])
def test_both_sides_of_the_errors_share_one_derivation_of_the_bars(spark, name):
    files = QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not any("lineitem" in f for f in files)
