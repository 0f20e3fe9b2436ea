from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.helpers import bars, column, day, rows
from tickloom.operators import indicators as I
from tickloom.operators import signals as S
from tickloom.operators.market import filter_dates


def crossing(spark, pairs):
    data = [("A", day(i), c, m) for i, (c, m) in enumerate(pairs)]
    return spark.createDataFrame(data, "ticker string, date date, close double, ma double")


def test_cross_signal(spark):
    df = crossing(spark, [(1.0, 2.0), (3.0, 2.0), (3.0, 2.0), (2.0, 2.0), (1.0, 2.0), (2.0, 2.0), (5.0, 2.0)])
    got = S.cross_signal(df, "close", "ma")
    assert column(got, "signal", "date") == [None, "BUY", None, None, "SELL", None, "BUY"]
    assert column(got, "buy_signal", "date") == [None, 3.0, None, None, None, None, 5.0]
    assert column(got, "sell_signal", "date") == [None, None, None, None, 1.0, None, None]


def test_first_row_of_a_range_never_signals(spark):
    df = crossing(spark, [(1.0, 2.0), (3.0, 2.0), (1.0, 2.0)])
    got = S.cross_signal(filter_dates(df, "2024-01-02", "2024-01-31"), "close", "ma")
    assert column(got, "signal", "date") == [None, "SELL"]


def test_weeks_are_split_at_the_turn_of_the_year(spark):
    dates = [dt.date(2024, 12, 23), dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2025, 1, 2), dt.date(2025, 1, 6)]
    df = bars(spark, {"A": [1.0, 5.0, 1.0, 5.0, 1.0]}, dates).withColumn("ma", F.lit(2.0))
    got = S.moving_average_period_signals(df, "ma", "ma", "week").orderBy("date", "year")
    assert [(r.date, r.year, r.close, r.signal) for r in got.collect()] == [
        (dt.date(2024, 12, 23), 2024, 1.0, None),
        (dt.date(2024, 12, 30), 2024, 1.0, None),
        (dt.date(2024, 12, 30), 2025, 5.0, "BUY"),
        (dt.date(2025, 1, 6), 2025, 1.0, "SELL"),
    ]


def test_week_number_order_puts_the_last_week_first(spark):
    dates = [dt.date(2024, 1, 10), dt.date(2024, 12, 23), dt.date(2024, 12, 30)]
    df = bars(spark, {"A": [5.0, 5.0, 1.0]}, dates).withColumn("ma", F.lit(2.0))
    got = S.moving_average_period_signals(df, "ma", "ma", "week", week_number_order=True)
    by_date = {r.date: r.signal for r in got.collect()}
    # 30 December is week 1 and so precedes 10 January.
    assert by_date[dt.date(2024, 12, 30)] is None
    assert by_date[dt.date(2024, 1, 8)] == "BUY"


def test_monthly_takes_last_values(spark):
    dates = [dt.date(2024, 1, 2), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    df = bars(spark, {"A": [9.0, 1.0, 3.0]}, dates).withColumn("ma", F.lit(2.0))
    got = rows(S.moving_average_period_signals(df, "ma", "ma", "month").select("date", "close", "signal"), "date")
    assert got == [(dt.date(2024, 1, 1), 1.0, None), (dt.date(2024, 2, 1), 3.0, "BUY")]


def test_band_signal_and_money(spark):
    data = [("A", day(i), c, 5.0, 9.0, 2.0) for i, c in enumerate([5.0, 1.004, 5.0, 9.5])]
    df = spark.createDataFrame(data, "ticker string, date date, close double, middle_band double, upper_band double, lower_band double")
    got = S.bollinger_signals(df)
    assert column(got, "signal", "date") == [None, "BUY", None, "SELL"]
    assert column(got, "buy_signal", "date")[1] == Decimal("1.00")
    assert column(got, "upper_band", "date")[0] == Decimal("9.00")


def test_macd_histogram_sign_is_read_in_cents(spark):
    data = [
        ("A", day(0), 1.0, 1.0, 1.004, -0.004, None, None),
        ("A", day(1), 1.0, 2.0, 1.0, 1.0, 1.0, 1.004),
        ("A", day(2), 1.0, 0.5, 1.0, -0.5, 2.0, 1.0),
    ]
    df = spark.createDataFrame(
        data,
        "ticker string, date date, close double, macd_line double, signal_line double, macd_histogram double, "
        "prev_macd_line double, prev_signal_line double",
    )
    got = S.macd_signals(df)
    assert column(got, "positive_histogram", "date") == [-0.004, 1.0, None]
    assert column(got, "negative_histogram", "date") == [None, None, -0.5]
    assert column(got, "signal", "date") == [None, "BUY", "SELL"]
    weekly = S.macd_signals(df, "week")
    assert rows(weekly.select("date", "macd_line")) == [(day(0), Decimal("0.50"))]


def test_golden_and_death_cross(spark):
    closes = [10.0] * 5 + [20.0] * 5 + [1.0] * 8
    averages = I.sma(bars(spark, {"A": closes}), windows=(2, 4))
    got = S.cross_signal(averages, "sma_2", "sma_4")
    found = [(r.date, r.signal) for r in got.where("signal is not null").orderBy("date").collect()]
    assert found == [(day(5), "BUY"), (day(10), "SELL")]
