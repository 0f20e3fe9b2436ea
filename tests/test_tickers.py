from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import bars, column, day, executed_plan, rows
from tickloom.operators import bars as B
from tickloom.operators import market
from tickloom.operators import tickers as T
from tickloom.operators.ranking import global_rank

DETAILS = (
    "ticker string, type string, market_cap double, sic_code string, sic_description string, branding_icon_url string, "
    "branding_logo_url string, total_employees int, name string, share_class_shares_outstanding bigint, "
    "weighted_shares_outstanding bigint, primary_exchange string"
)


def enriched(spark, caps: dict[str, float | None]):
    tickers = spark.createDataFrame([(t, f"{t} Inc", True) for t in caps], "ticker string, name string, active boolean")
    details = spark.createDataFrame(
        [(t, "CS", cap, "7", "d", "icon", "logo", 1, "other", 1, 1, "X") for t, cap in caps.items()], DETAILS
    )
    codes = spark.createDataFrame([(7, "Office", "Industry")], "code int, office string, industry string")
    return T.enrich_tickers(tickers, details, codes)


def test_enrichment_needs_all_three(spark):
    got = enriched(spark, {"A": 1e9})
    assert got.columns == list(T.ENRICHED_COLUMNS)
    row = got.first()
    assert (row.name, row.industry, row.sic_code) == ("A Inc", "Industry", "7")


def test_classification(spark):
    caps = {"MEGA": 3e11, "BIG": 5e10, "TINY": 1e8, "NONE": None}
    b = bars(spark, {t: [100.0] * 3 for t in [*caps, "ALONE"]}).withColumn("volume", F.lit(1_000_000.0))
    scored = T.score_tickers(T.liquidity(b, B.latest(b)), enriched(spark, caps))
    found = {r.ticker: (r.market_cap_category, r.liquidity_score) for r in scored.collect()}
    assert found == {
        "MEGA": ("Mega Cap", 5), "BIG": ("Large Cap", 5), "TINY": ("Micro Cap", 5),
        "NONE": ("Micro Cap", 5), "ALONE": ("Micro Cap", 5),
    }
    classified = rows(T.classify_tickers(scored).select("ticker", "overall_rank", "market_cap_billions"), "overall_rank")
    # The two without a cap share the first rank and are then left out.
    assert classified == [("MEGA", 3, 300.0), ("BIG", 4, 50.0)]
    assert column(T.leading_tickers(scored, 1), "ticker", "ticker") == ["MEGA"]
    assert rows(T.category_list(scored)) == [("Mega Cap",), ("Large Cap",)]
    picked = T.ticker_picker(T.classify_tickers(scored))
    assert rows(picked) == [("MEGA - MEGA Inc", "MEGA")]


def test_liquidity_looks_at_five_months(spark):
    dates = [dt.date(2023, 7, 30), dt.date(2023, 8, 1), dt.date(2024, 1, 1)]
    b = bars(spark, {"A": [1.0, 2.0, 4.0]}, dates)
    got = T.liquidity(b, B.latest(b)).first()
    assert got.avg_daily_volume == 250.0
    assert (got.min_daily_traded_value, got.max_daily_traded_value) == (400.0, 1200.0)


def test_global_rank_equals_rank(spark):
    data = [(i, "a" if i % 3 else None if i % 4 else "b", None if i % 5 == 0 else float((i * 7) % 40)) for i in range(500)]
    df = spark.createDataFrame(data, "id int, grp string, score double").repartition(7)
    df.createOrReplaceTempView("scores")
    expected = spark.sql(
        "SELECT id, rank() OVER (ORDER BY score DESC NULLS FIRST) AS r, "
        "rank() OVER (PARTITION BY grp ORDER BY score DESC NULLS FIRST) AS g FROM scores"
    )
    got = global_rank(global_rank(df, F.col("score"), "r"), F.col("score"), "g", ["grp"])
    assert rows(got.select("id", "r", "g"), "id") == rows(expected, "id")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=60))
def test_global_rank_property(spark, scores):
    df = spark.createDataFrame(list(enumerate(scores)), "id int, score int")
    got = dict(rows(global_rank(df, F.col("score"), "r").select("id", "r")))
    key = [float("inf") if s is None else s for s in scores]
    assert got == {i: 1 + sum(other > k for other in key) for i, k in enumerate(key)}


def news_table(spark):
    data = [
        ("A", "positive", "r1", day(5), "u1"),
        ("A", "negative", "r2", day(5), "u2"),
        ("A", "mixed", "r3", day(1), "u0"),
        ("B", "neutral", "r4", day(2), "u4"),
        ("Z", "neutral", "r5", day(2), "u5"),
    ]
    return spark.createDataFrame(data, "ticker string, sentiment string, sentiment_reasoning string, date date, article_url string")


def test_two_latest_sentiments(spark):
    table = enriched(spark, {"A": 1e9, "B": 1e9, "C": 1e9})
    got = T.tickers_with_news(table, news_table(spark)).select(
        "ticker", "current_sentiment", "previous_sentiment", "date", "current_reasoning"
    )
    assert rows(got, "ticker") == [("A", "positive", "negative", day(5), "r1"), ("B", "neutral", None, day(2), "r4")]
    pivoted = T.pivot_sentiments(table, news_table(spark)).select("ticker", "current_sentiment", "previous_sentiment")
    assert rows(pivoted, "ticker") == [("A", "positive", "negative"), ("B", "neutral", None)]


def test_only_the_newest_items_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "news")
    news_table(spark).write.parquet(path)
    plan = executed_plan(T.latest_news(spark.read.parquet(path), 2))
    assert "WindowGroupLimit" in plan


def test_not_yet_graded(spark):
    classified = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), ("D", 4)], "ticker string, overall_rank int")
    grades = spark.createDataFrame([("B",), (None,)], "ticker string")
    assert column(T.not_yet_graded(classified, grades), "ticker", "overall_rank") == ["A", "C", "D"]
    assert rows(T.not_yet_graded(classified, grades, ("C",), 2, 5)) == [("D", 4)]


def test_market_overview(spark):
    dates = [dt.date(2023, 12, 28), dt.date(2024, 1, 2)]
    b = bars(spark, {"A": [10.0, 11.0], "B": [10.0, 9.0], "C": [10.0, 12.0]}, dates)
    old = bars(spark, {"D": [1.0, 50.0]}, [dt.date(2022, 1, 3), dt.date(2022, 1, 4)])
    months = B.month_end_changes(B.cumulate_months(b.union(old)))
    leaders = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    # In January the month before is December of the year before.
    as_of = F.lit(dt.date(2024, 1, 15))
    assert rows(market.market_sentiment(months, leaders, as_of)) == [(1, "Bullish")]
    tie = leaders.where("ticker <> 'C'")
    assert rows(market.market_sentiment(months, tie, as_of)) == [(0, "Bearish")]
    facts = spark.createDataFrame([("C", "mixed", "logo", "icon")], "ticker string, current_sentiment string, branding_logo_url string, branding_icon_url string")
    assert rows(market.market_leader(months, leaders, facts, as_of)) == [("C", 12.0, 20.0, "mixed", "logo", "icon")]
    stocks = market.best_and_worst_stock(market.newest_movers(months)).first()
    assert (stocks.top_stock_ticker, stocks.worst_stock_ticker) == ("C", "B")
    listed = market.watchlist(market.newest_movers(months), enriched(spark, {"A": 1e9}), ("A", "B", "D"))
    assert rows(listed.select("ticker", "name", "direction")) == [("A", "A Inc", "up"), ("B", None, "down")]
    ranked = rows(market.rank_movers(market.newest_movers(months), 2), "side", "position")
    assert [(r[0], r[1], r[2]) for r in ranked] == [("best", 1, "C"), ("best", 2, "A"), ("worst", 1, "B"), ("worst", 2, "A")]


def test_sectors_average_every_month_of_the_year(spark):
    dates = [dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 2, 1)]
    months = B.month_end_changes(B.cumulate_months(bars(spark, {"A": [10.0, 11.0, 22.0]}, dates)))
    industry = spark.createDataFrame([("A", "Oil")], "ticker string, industry string")
    got = market.sector_performance(months, industry, F.lit(dt.date(2024, 2, 2)))
    assert rows(got) == [("Oil", 55.00000000000001)] or abs(got.first().avg_change_pct - 55.0) < 1e-9
    assert market.best_and_worst_sector(got).first().worst_sector == "Oil"


def test_stock_trend_defaults(spark):
    b = bars(spark, {"AAPL": [1.0] * 60, "A": [1.0] * 60})
    as_of = F.lit(day(59))
    assert market.stock_trend(b, as_of).count() == 31
    assert market.stock_trend(b, as_of, days=-1).count() == 31
    assert market.stock_trend(b, as_of, days="many").count() == 31
    assert market.stock_trend(b, as_of, ticker=None, days="5").count() == 12
