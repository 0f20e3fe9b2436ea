from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickloom.plans import serving
from tickloom.plans.marts import Marts
from tickloom.workload.tables import Tables

FOLDER = "/root/testdata/sf0.001"
RANGE = ("1996-01-01", "1999-12-31")


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    stored = Marts(Tables(spark, FOLDER), True)
    stored.save_all(str(tmp_path_factory.mktemp("marts")))
    return stored


def test_one_ticker_equals_its_part_of_all(marts):
    ticker = serving.categories(marts) and marts.classified.orderBy("overall_rank").first().ticker
    for build in (
        lambda t: serving.moving_average(marts, "sma", *RANGE, ticker=t),
        lambda t: serving.moving_average(marts, "wma", *RANGE, aggregation="monthly", ticker=t),
        lambda t: serving.bollinger(marts, *RANGE, aggregation="weekly", ticker=t),
        lambda t: serving.macd(marts, *RANGE, category=None, ticker=t),
        lambda t: serving.candlestick(marts, "last_1_year", "weekly", ticker=t),
    ):
        alone, part = build(ticker), build(None).where(F.col("ticker") == ticker)
        assert alone.count() > 0
        assert alone.exceptAll(part).count() == 0 and part.exceptAll(alone).count() == 0


def test_bad_arguments(marts):
    with pytest.raises(ValueError, match="aggregation"):
        serving.bollinger(marts, *RANGE, aggregation="yearly")
    with pytest.raises(ValueError, match="moving average"):
        serving.moving_average(marts, "close", *RANGE)
    with pytest.raises(ValueError, match="windows"):
        serving.moving_average(marts, "sma", *RANGE, window=11)


def test_dashboard_without_recent_data_reads_not_available(marts):
    row = serving.market_dashboard(marts, F.to_date(F.lit("2030-01-01"))).first()
    assert row.market_sentiment == "Bearish"
    assert row.leader.ticker == "N/A" and row.leader.price == 0.0
    assert row.hottest_sector.name == "N/A" and row.hottest_sector.change_pct == 0.0
    assert row.top_stock.ticker != "N/A"
    assert row.market_summary == []


def test_trend_and_info(marts):
    ticker = marts.classified.first().ticker
    info, trend = serving.stock_trend(marts, serving.B.latest(marts.daily), ticker, 90)
    assert info.count() == 1
    assert {r.ticker for r in trend.collect()} == {ticker}
    assert serving.market_sentiment(marts, serving.B.latest(marts.daily)).count() == 1
    assert serving.tickers(marts, None).count() == marts.classified.count()


def test_month_ends_of_the_dashboard_are_derived_once(marts):
    assert "bars#" in serving.market_sentiment(marts, serving.B.latest(marts.daily))._jdf.queryExecution().optimizedPlan().toString()
    dashboard = serving.market_dashboard(marts, serving.B.latest(marts.daily))
    plan = dashboard._jdf.queryExecution().optimizedPlan().toString()
    assert "prev_close#" in plan and "bars#" not in plan
