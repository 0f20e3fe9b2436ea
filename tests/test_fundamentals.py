from __future__ import annotations

import datetime as dt

import pytest

from tests.helpers import bars, column, day, executed_plan, rows
from tickloom.operators import fundamentals as FU

CALENDAR = (
    "ticker string, year int, date date, hour int, quarter int, epsActual double, epsEstimate double, "
    "revenueActual bigint, revenueEstimate bigint"
)
HISTORY = "ticker string, year int, date date, quarter int, actual double, estimate double, surprise double, surprisePercent double"


def calendar(spark):
    return spark.createDataFrame(
        [
            ("A", 2024, day(0), 16, 1, 3.0, -2.0, 110, 100),
            ("A", 2024, day(90), 16, 2, 1.0, 2.0, 50, 0),
            ("A", 2024, day(180), 16, 3, 1.0, 0.0, 50, 50),
        ],
        CALENDAR,
    )


def test_surprises(spark):
    got = FU.earnings_surprises(calendar(spark)).select(
        "date", "epsSurprise", "epsSurprisePercent", "revenueSurprise", "revenueSurprisePercent", "row_num"
    )
    assert rows(got, "date") == [(day(0), 5.0, 250.0, 10, 10.0, 1), (day(90), -1.0, -50.0, 50, 5000.0, 2)]


def test_union_with_history_drops_copies(spark):
    history = spark.createDataFrame([("B", 2020, day(0), 1, 1.0, 2.0, -1.0, -50.0)] * 1, HISTORY)
    got = FU.earnings_surprises(calendar(spark).union(calendar(spark).limit(0)), history)
    assert got.count() == 3
    assert got.where("ticker = 'B'").first().revenueSurprise is None


def test_mart_takes_the_year_of_the_date(spark):
    surprises = FU.earnings_surprises(calendar(spark)).withColumn("year", FU.F.lit(1900))
    assert set(column(FU.earnings_mart(surprises), "year", "date")) == {2024}


def test_prices_after_an_event_on_a_day_without_bars(spark):
    b = bars(spark, {"A": [10.0, 11.0, 12.0, 13.0], "B": [1.0]}, [day(0), day(3), day(4), day(7)])
    events = spark.createDataFrame([("A", day(1)), ("A", day(0)), ("A", day(9)), ("B", day(0))], "ticker string, date date")
    got = FU.normalised_performance(events, b, 2)
    found = rows(got.select("ticker", "date", "offset", "price_date", "performance"), "ticker", "date", "offset")
    assert [f[:4] for f in found] == [
        ("A", day(0), 0, day(0)), ("A", day(0), 1, day(3)), ("A", day(0), 2, day(4)),
        ("A", day(1), 0, day(3)), ("A", day(1), 1, day(4)), ("A", day(1), 2, day(7)),
        ("B", day(0), 0, day(0)),
    ]
    assert found[4][4] == pytest.approx(12 / 11 - 1)
    plan = executed_plan(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_correlation(spark):
    closes = {"A": [100.0, 110.0], "B": [100.0, 120.0], "C": [100.0, 130.0]}
    events = spark.createDataFrame(
        [("A", day(0), 1, 1.0), ("B", day(0), 1, 2.0), ("C", day(0), 1, 3.0)],
        "ticker string, date date, quarter int, epsSurprisePercent double",
    )
    got = FU.surprise_return_correlation(events, bars(spark, closes), 1).first()
    assert (got.year, got.quarter, got.events) == (2024, 1, 3)
    assert got.correlation == pytest.approx(1.0)


def test_last_quarters(spark):
    data = [("A", dt.date(2023, 1, 1) + dt.timedelta(days=90 * i), i % 4 + 1, float(i)) for i in range(6)]
    df = spark.createDataFrame(data, "ticker string, date date, quarter int, epsSurprisePercent double")
    assert column(FU.last_quarters(df), "epsSurprisePercent", "quarters_back") == [5.0, 4.0, 3.0, 2.0]
