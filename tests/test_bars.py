from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import bars, column, day, executed_plan, rows
from tickloom.functions import columns as C
from tickloom.operators import bars as B
from tickloom.operators import staging


def split_table(spark, *items):
    return spark.createDataFrame(list(items), "ticker string, split_from int, split_to int, date date")


def test_splits_strictly_after_a_bar_count(spark):
    b = bars(spark, {"A": [12.0, 12.0, 12.0], "B": [5.0]})
    splits = split_table(spark, ("A", 1, 2, day(1)), ("A", 1, 3, day(2)), ("A", 2, 1, day(9)))
    got = B.adjust_for_splits(b, splits)
    # Factors: 2*3/2, 3/2, 1/2; the split on a bar's own day does not touch it.
    assert column(got.where("ticker = 'A'"), "close", "date") == [4.0, 8.0, 24.0]
    assert column(got.where("ticker = 'A'"), "volume", "date") == [300.0, 300.0, 150.0]
    assert column(got.where("ticker = 'A'"), "transactions", "date") == [1, 2, 3]
    assert column(got.where("ticker = 'B'"), "close", "date") == [5.0]
    assert B.adjust_for_splits(b, splits, apply=False) is b


def test_split_join_multiplies_no_bar(spark):
    b = bars(spark, {"A": [1.0] * 10})
    splits = split_table(spark, *[("A", 1, 2, day(i)) for i in range(10)] * 3)
    got = B.adjust_for_splits(b, splits)
    assert got.count() == 10
    assert B.split_factors(splits).select(F.size("splits")).first()[0] == 10
    assert "CartesianProduct" not in executed_plan(got) and "NestedLoop" not in executed_plan(got)


def test_months_and_back(spark):
    b = bars(spark, {"A": [float(i) for i in range(70)], "B": [1.0, 2.0]})
    months = B.cumulate_months(b)
    assert column(months.where("ticker = 'A'"), "record_count", "year", "month_num") == [31, 29, 10]
    assert column(months.where("ticker = 'A'"), "first_date", "month_num")[1] == dt.date(2024, 2, 1)
    back = B.unpack_bars(months).select(*b.columns)
    assert rows(back, "ticker", "date") == rows(b, "ticker", "date")


def test_exact_copies_are_dropped_but_counted(spark):
    b = bars(spark, {"A": [1.0, 2.0]})
    month = B.cumulate_months(b.union(b)).first()
    assert month.record_count == 4
    assert [x.close for x in month.bars] == [1.0, 2.0]


def test_period_flags_use_the_greatest_month_of_all_years(spark):
    dates = [dt.date(2023, 11, 1), dt.date(2024, 2, 1)]
    months = B.cumulate_months(bars(spark, {"A": [1.0, 2.0]}, dates))
    got = rows(B.flag_periods(months).select("year", "month_num", "is_current_month", "is_current_year"), "year")
    assert got == [(2023, 11, False, False), (2024, 2, False, True)]


def test_candles(spark):
    b = bars(spark, {"A": [5.0, 9.0, 1.0, 7.0]}, [day(0), day(1), day(2), day(8)])
    assert rows(B.candles(b, "week"), "time") == [
        ("A", day(0), 5.0, 10.0, 0.0, 1.0, 600.0),
        ("A", day(7), 7.0, 8.0, 6.0, 7.0, 400.0),
    ]
    assert B.candles(b, "month").count() == 1
    assert B.candles(b).columns == ["ticker", "time", "open", "high", "low", "close", "volume"]
    with pytest.raises(ValueError):
        B.candles(b, "year")


def test_previous_close_falls_back_on_the_month_before(spark):
    dates = [dt.date(2023, 12, 28), dt.date(2023, 12, 29), dt.date(2024, 1, 2)]
    changes = B.month_end_changes(B.cumulate_months(bars(spark, {"A": [1.0, 2.0, 3.0], "B": [4.0]}, dates)))
    got = rows(changes.select("ticker", "year", "close", "prev_close"), "ticker", "year")
    assert got == [("A", 2023, 2.0, 1.0), ("A", 2024, 3.0, 2.0), ("B", 2023, 4.0, None)]
    newest = {r.ticker: r.pct_change for r in B.latest_changes(changes).collect()}
    assert newest == {"A": 50.0, "B": None}


def test_staging(spark):
    tickers = spark.createDataFrame(
        [
            ("A", "b", "stocks", "CS", True),
            ("A", "a", "stocks", "CS", True),
            ("B", "b", "otc", "CS", True),
            ("C", "c", "stocks", None, True),
        ],
        "ticker string, name string, market string, type string, active boolean",
    )
    staged = staging.stage_tickers(tickers)
    assert rows(staged) == [("A", "a", "stocks", "CS", True)]
    b = bars(spark, {"A": [1.0, 2.0, 3.0], "B": [1.0]}).withColumn(
        "volume", F.when(F.col("close") == 2, 0.0).otherwise(F.col("volume"))
    ).withColumn("transactions", F.when(F.col("close") != 3, F.col("transactions")))
    assert rows(staging.stage_bars(b, staged).select("ticker", "close")) == [("A", 1.0)]
    splits = split_table(spark, ("A", 1, 2, day(0)), ("A", None, 2, day(0)), ("A", 1, 0, day(0)), ("A", 0, 2, day(0)))
    assert staging.stage_splits(splits).count() == 1


@pytest.mark.parametrize(
    ("period", "first"),
    [
        ("last_5_days", dt.date(2024, 3, 26)),
        ("mtd", dt.date(2024, 3, 1)),
        ("last_3_months", dt.date(2023, 12, 31)),
        ("last_6_months", dt.date(2023, 9, 30)),
        ("last_1_year", dt.date(2023, 3, 31)),
        ("last_4_years", dt.date(2020, 3, 31)),
        ("ytd", dt.date(2024, 1, 1)),
        ("no such period", dt.date(2019, 1, 1)),
    ],
)
def test_named_periods(spark, period, first):
    days = spark.sql("SELECT explode(sequence(date'2019-01-01', date'2024-03-31')) AS date")
    kept = days.where(C.within_period(F.col("date"), B.latest(days), period))
    assert kept.agg(F.min("date")).first()[0] == first


def test_period_condition_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, {"A": [1.0] * 30}).write.parquet(path)
    stored = spark.read.parquet(path)
    recent = stored.where(C.within_period(F.col("date"), B.latest(stored), "last_5_days")).select("ticker", "close")
    plan = executed_plan(recent)
    assert "Subquery" in plan or "subquery" in plan
    assert recent.count() == 6


def test_epochs_become_utc_dates(spark):
    got = spark.sql("SELECT 1704067199999L AS ms, 1704067200000000000L AS ns, 0L AS zero").select(
        C.date_from_millis(F.col("ms")), C.date_from_nanos(F.col("ns")), C.date_from_millis(F.col("zero")),
        C.date_from_nanos(F.col("ns") - 1), C.date_from_nanos(F.lit(-1).cast("bigint")),
    )
    assert rows(got) == [(dt.date(2023, 12, 31), dt.date(2024, 1, 1), None, dt.date(2023, 12, 31), dt.date(1969, 12, 31))]


def test_grades(spark):
    cases = [
        ("Sector Underperform", None, "HOLD"),
        ("Strong Sell", None, "BUY"),
        ("Below Average", None, "HOLD"),
        ("Sell", None, "SELL"),
        ("Reduce", "upgrade", "BUY"),
        (None, "downgrade", "SELL"),
        ("Overweight", "downgrade", "BUY"),
        (None, None, None),
        ("unclear", "maintain", None),
    ]
    df = spark.createDataFrame(cases, "grade string, action string, expected string")
    wrong = df.where(~C.classify_grade(F.col("grade"), F.col("action")).eqNullSafe(F.col("expected")))
    assert rows(wrong) == []


def test_cents(spark):
    got = spark.sql("SELECT 12345 AS c").select(C.cents_to_dollars(F.col("c")))
    assert str(got.first()[0]) == "123.45"
    assert got.schema.fields[0].dataType.simpleString() == "decimal(16,2)"
