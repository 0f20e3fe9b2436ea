"""Registered queries: one per operator, over the whole derived tables.

Every function takes the session and the folder of test tables.  Computed
doubles are rounded here, and only here, so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import constants as K
from tickloom import schemas
from tickloom.functions import columns as C
from tickloom.operators import bars as B
from tickloom.operators import fundamentals, indicators, market, profiles, quality, signals, staging, validation
from tickloom.operators import tickers as TK
from tickloom.plans import serving, upkeep
from tickloom.plans.marts import Marts
from tickloom.session import freeze, scratch_path
from tickloom.sources import normalize, readers, writers
from tickloom.streaming import late, points, sinks, ticks
from tickloom.streaming.velocity import velocities_to_end
from tickloom.workload.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Range of dates the range-relative queries look at.
RANGE = ("1996-01-01", "1999-12-31")
PERIODS = (
    "last_5_days", "mtd", "last_3_months", "last_6_months", "last_1_year", "last_4_years", "ytd", "everything",
)
# The watchlist in terms of the derived tickers.
WATCHED = tuple(f"T{n:0{K.TICKER_DIGITS}d}" for n in range(12))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that the last digits, which depend on the order of additions, do not count.

    HAIR keeps exact halves from being rounded either way; adding zero turns a
    negative zero into a positive one.
    """
    return df.select(
        *[
            (F.round(F.col(f.name) + K.HAIR, digits) + 0.0).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, digits: int | None = 6) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a query over the derived tables under a name."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            result = build(Tables(spark, folder))
            return result if digits is None else rounded(result, digits)

        QUERIES[name] = run
        return run

    return register


def in_range(df: DataFrame) -> DataFrame:
    return market.filter_dates(df, *RANGE)


def as_json(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


# Sources and sinks.


@query("s1_bars_csv")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "bars-csv")
    nanos = (F.unix_date("date").cast("bigint") * 86_400 + 18_000) * 1_000_000_000
    raw = t.bars.select(
        "ticker", "volume", "open", "close", "high", "low", nanos.alias("window_start"), "transactions",
        F.year("date").alias("y"), F.month("date").alias("m"),
    )
    raw.write.partitionBy("y", "m").option("header", True).csv(path)
    return readers.read_bars_csv(t.spark, f"{path}/*/*")


@query("s2_daily_json")
def _(t: Tables) -> DataFrame:
    millis = (F.unix_date("date").cast("bigint") * 86_400 + 75_600) * 1000
    item = F.struct(
        F.col("ticker").alias("T"), F.col("volume").alias("v"), F.col("open").alias("o"), F.col("close").alias("c"),
        F.col("high").alias("h"), F.col("low").alias("l"), millis.alias("t"), F.col("transactions").alias("n"),
    )
    # A response page holds one day of at most a hundred tickers.
    page = F.floor(F.substring("ticker", 2, K.TICKER_DIGITS).cast("bigint") / 100)
    pages = t.bars.groupBy("date", page.alias("page")).agg(F.collect_list(item).alias("results"))
    return normalize.normalize_daily_json(as_json(pages, "results"))


@query("s3_ticker_details_json", digits=None)
def _(t: Tables) -> DataFrame:
    results = F.struct(
        "ticker", "name", "type", "market_cap", "sic_code", "sic_description", "total_employees",
        F.struct(F.col("branding_logo_url").alias("logo_url"), F.col("branding_icon_url").alias("icon_url")).alias(
            "branding"
        ),
        "share_class_shares_outstanding", "weighted_shares_outstanding", "primary_exchange",
    )
    entry = F.struct(F.col("ticker").alias("request_id"), results.alias("results"), F.lit("OK").alias("status"))
    documents = t.ticker_details.select(F.to_json(F.create_map("ticker", entry)).alias("value"))
    return normalize.parse_ticker_details(documents)


@query("s4_flatten_news")
def _(t: Tables) -> DataFrame:
    number = F.substring("article_url", 5, 20).cast("bigint")
    insight = F.struct("ticker", "sentiment", "sentiment_reasoning")
    other = F.struct(
        F.lit("OTHER").alias("ticker"), F.lit("neutral").alias("sentiment"), F.lit("none").alias("sentiment_reasoning")
    )
    insights = F.when(number % 7 == 0, F.slice(F.array(other), 1, 0)).otherwise(F.array(insight, other))
    published = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T21:30:00Z"))
    documents = as_json(t.news, published.alias("published_utc"), "article_url", insights.alias("insights"))
    return normalize.flatten_news(normalize.parse(documents, schemas.NEWS_ITEM))


def _day(column: str = "date") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


@query("s5_map_earnings")
def _(t: Tables) -> DataFrame:
    documents = as_json(
        t.earnings_calendar, F.col("ticker").alias("symbol"), "year", _day().alias("date"), "hour", "quarter",
        "epsActual", "epsEstimate", "revenueActual", "revenueEstimate",
    )
    return normalize.map_earnings(normalize.parse(documents, schemas.EARNINGS_ITEM))


@query("s5_map_surprises")
def _(t: Tables) -> DataFrame:
    documents = as_json(
        t.earnings_surprises, F.col("ticker").alias("symbol"), "year", _day().alias("period"), "quarter",
        "actual", "estimate", "surprise", "surprisePercent",
    )
    return normalize.map_surprises(normalize.parse(documents, schemas.SURPRISE_ITEM))


@query("s5_map_grades")
def _(t: Tables) -> DataFrame:
    symbol = F.when(F.col("action") != "maintain", F.col("ticker"))
    documents = as_json(
        t.grades, symbol.alias("symbol"), _day().alias("date"), "gradingCompany", "previousGrade", "newGrade", "action"
    )
    return normalize.map_grades(normalize.parse(documents, schemas.GRADE_ITEM))


@query("s5_map_splits")
def _(t: Tables) -> DataFrame:
    documents = as_json(
        t.splits, _day().alias("execution_date"), F.col("split_from").cast("string").alias("split_from"),
        F.col("split_to").cast("string").alias("split_to"), "ticker",
    )
    return normalize.map_splits(normalize.parse(documents, schemas.SPLIT_ITEM))


@query("s5_map_exchanges")
def _(t: Tables) -> DataFrame:
    return normalize.map_exchanges(normalize.parse(as_json(t.exchanges, "*"), schemas.EXCHANGE_ITEM))


@query("s5_map_tickers")
def _(t: Tables) -> DataFrame:
    return normalize.map_tickers(normalize.parse(as_json(t.tickers, "*"), schemas.TICKERS))


@query("s6_slice")
def _(t: Tables) -> DataFrame:
    return readers.read_slice(t.clean_bars, start_date="1996-03-01", end_date="1998-06-30")


@query("s7_write_clustered")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "clustered")
    writers.write_clustered(t.clean_bars, path, "fail", ("ticker", "date"))
    return t.spark.read.parquet(path)


def _with_year(df: DataFrame) -> DataFrame:
    return df.select("ticker", "date", "close", "volume", F.year("date").alias("year"))


@query("s8_replace_partitions")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "replaced")
    bars = _with_year(t.clean_bars)
    writers.replace_partitions(bars, path, "year")
    again = bars.where(F.col("year") == 1997).withColumn("volume", F.col("volume") * 2)
    writers.replace_partitions(again, path, "year")
    writers.replace_partitions(again, path, "year")
    return t.spark.read.schema(bars.schema).parquet(path)


@query("s9_replace_if_nonempty")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "kept")
    writers.replace_if_nonempty(t.grades, path)
    writers.replace_if_nonempty(t.grades.where(F.col("ticker") == "nobody"), path)
    return t.spark.read.schema(t.grades.schema).parquet(path)


@query("s10_upsert")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "upserted")
    keys = ("ticker", "date", "year")
    bars = _with_year(t.clean_bars).withColumn("record", F.lit(0))
    writers.upsert(bars.where(F.col("year") < 2000), path, keys, "year", "record")
    late = bars.where(F.col("year") >= 1999)
    # Every key comes twice; its last record wins.
    first, last = (late.withColumns({"close": F.col("close") + more, "record": F.lit(n)}) for n, more in ((1, 9), (2, 1)))
    writers.upsert(last.unionByName(first), path, keys, "year", "record")
    return t.spark.read.schema(bars.schema).parquet(path).drop("record")


@query("s11_incremental_append")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "incremental")
    bars = t.clean_bars.select("ticker", "date", "close")
    writers.incremental_append(bars.where(F.col("date") <= F.lit("1998-06-30").cast("date")), path)
    writers.incremental_append(bars, path)
    writers.incremental_append(bars, path)
    return t.spark.read.schema(bars.schema).parquet(path).select(*bars.columns)


@query("s12_seed")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "seed")
    names = t.read("customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name"))
    names.write.option("header", True).csv(path)
    return readers.read_seed(t.spark, path)


@query("s13_json_records")
def _(t: Tables) -> DataFrame:
    return writers.to_json_records(
        t.splits.select(F.col("ticker").alias("TICKER"), F.col("split_from").alias("SPLIT_FROM"), F.col("split_to").alias("Split_To"))
    )


# Staging and filters.


@query("f1_stage_bars")
def _(t: Tables) -> DataFrame:
    return t.marts.bars


@query("f2_stage_tickers")
def _(t: Tables) -> DataFrame:
    return t.marts.tickers


@query("f3_stage_ticker_details", digits=None)
def _(t: Tables) -> DataFrame:
    return t.marts.ticker_details


@query("f4_stage_splits")
def _(t: Tables) -> DataFrame:
    return t.marts.splits


@query("f5_stage_earnings_calendar")
def _(t: Tables) -> DataFrame:
    return t.marts.calendar


@query("f6_stage_earnings_surprises")
def _(t: Tables) -> DataFrame:
    return t.marts.surprise_history


@query("f7_stage_grades")
def _(t: Tables) -> DataFrame:
    return staging.stage_grades(t.grades)


@query("f8_stage_exchanges")
def _(t: Tables) -> DataFrame:
    return staging.stage_exchanges(t.exchanges)


@query("f9_stage_news")
def _(t: Tables) -> DataFrame:
    return t.marts.news


@query("f9_stage_sic_codes")
def _(t: Tables) -> DataFrame:
    return staging.stage_sic_codes(t.sic_codes)


@query("f10_time_periods")
def _(t: Tables) -> DataFrame:
    end = B.latest(t.clean_bars)
    matching = F.array_compact(
        F.array(*[F.when(C.within_period(F.col("date"), end, p), F.lit(p)) for p in PERIODS])
    )
    return t.clean_bars.select("ticker", "date", "close", F.explode(matching).alias("period"))


@query("f11_date_range")
def _(t: Tables) -> DataFrame:
    return in_range(t.clean_bars.select("ticker", "date", "close"))


@query("f12_category_filter")
def _(t: Tables) -> DataFrame:
    return TK.in_category(t.marts.daily.select("ticker", "date", "close"), t.marts.scored, "Large Cap")


@query("f13_category_list")
def _(t: Tables) -> DataFrame:
    return TK.category_list(t.marts.scored)


@query("f14_picker_category")
def _(t: Tables) -> DataFrame:
    return TK.ticker_picker(t.marts.classified)


@query("f14_picker_all")
def _(t: Tables) -> DataFrame:
    return TK.ticker_picker(t.marts.classified, None)


@query("f15_earnings_mart")
def _(t: Tables) -> DataFrame:
    return t.plain_marts.earnings_mart


@query("f16_stock_trend")
def _(t: Tables) -> DataFrame:
    return market.stock_trend(t.marts.daily, B.latest(t.marts.daily), None, -5)


@query("f16_stock_info")
def _(t: Tables) -> DataFrame:
    return market.stock_info(t.marts.classified, None)


# Joins.


@query("j1_ticker_enrichment", digits=None)
def _(t: Tables) -> DataFrame:
    return t.marts.enriched


@query("j2_liquidity_left_join", digits=2)
def _(t: Tables) -> DataFrame:
    return t.marts.scored


@query("j3_later_splits")
def _(t: Tables) -> DataFrame:
    splits = B.split_factors(t.marts.splits)
    later = F.filter("splits", lambda s: s["date"] > F.col("date"))
    return t.marts.bars.join(splits, "ticker", "left").select(
        "ticker", "date", F.coalesce(F.size(later), F.lit(0)).alias("later_splits")
    )


@query("j6_leading_bars")
def _(t: Tables) -> DataFrame:
    leaders = TK.leading_tickers(t.marts.scored)
    return t.marts.daily.join(leaders, "ticker", "left_semi").select("ticker", "date", "close")


@query("j7_vendor_join")
def _(t: Tables) -> DataFrame:
    return _errors(t, "sma", K.DAILY_ERROR_THRESHOLD).select("ticker", "timestamp", "sma_20_vendor", "sma_20_calculated")


@query("j8_not_yet_graded")
def _(t: Tables) -> DataFrame:
    return TK.not_yet_graded(t.marts.classified, t.sparse_grades)


@query("j10_latest_year_rows")
def _(t: Tables) -> DataFrame:
    months = t.marts.cumulated
    return months.where(F.col("year") == B.latest(months, "year")).select(
        "ticker", "year", "month_num", "record_count", "first_date", "last_date"
    )


# Aggregations.


@query("a1_split_adjust")
def _(t: Tables) -> DataFrame:
    return t.marts.daily


def _months_table(months: DataFrame) -> DataFrame:
    closes = F.transform("bars", lambda b: F.date_format(b["date"], "yyyy-MM-dd"))
    return months.select(
        "ticker", "year", "month_num", F.array_join(closes, ",").alias("days"),
        F.aggregate("bars", F.lit(0.0), lambda acc, b: acc + b["close"]).alias("close_sum"),
        "record_count", "first_date", "last_date",
    )


@query("a2_cumulated_months")
def _(t: Tables) -> DataFrame:
    return _months_table(t.marts.cumulated)


@query("a2_months_by_loads")
def _(t: Tables) -> DataFrame:
    """Loads that overlap in months: by day of the month, so that most bars come late."""
    path = scratch_path(t.spark, "months")
    for third in range(3):
        upkeep.update_months(t.spark, path, t.marts.daily.where(F.dayofmonth("date") % 3 == third))
    return _months_table(t.spark.read.parquet(path))


@query("a1_splits_by_loads")
def _(t: Tables) -> DataFrame:
    """Splits arrive in two loads, the older ones last."""
    raw, adjusted = (scratch_path(t.spark, name) for name in ("raw", "adjusted"))
    upkeep.store_bars(t.marts.bars, raw)
    late = F.col("date") < F.to_date(F.lit("1999-01-01"))
    upkeep.refresh_adjusted(t.spark, raw, adjusted, t.marts.splits.where(~late))
    upkeep.refresh_adjusted(t.spark, raw, adjusted, t.marts.splits, t.marts.splits.where(late))
    return t.spark.read.parquet(adjusted).select(*t.marts.daily.columns)


@query("a3_liquidity", digits=2)
def _(t: Tables) -> DataFrame:
    return TK.liquidity(B.unpack_bars(t.marts.cumulated), B.latest(t.marts.daily))


@query("a4_buckets")
def _(t: Tables) -> DataFrame:
    return t.marts.scored.groupBy("market_cap_category", "liquidity_score").agg(F.count("*").alias("tickers"))


@query("a5_classifier")
def _(t: Tables) -> DataFrame:
    return t.marts.classified


@query("a6_sentiment_pivot", digits=None)
def _(t: Tables) -> DataFrame:
    return TK.pivot_sentiments(t.marts.enriched, t.marts.news)


@query("a7_tickers_with_news", digits=None)
def _(t: Tables) -> DataFrame:
    return t.marts.with_news


@query("a8_candles_weekly")
def _(t: Tables) -> DataFrame:
    return B.candles(t.clean_bars, "week")


@query("a8_candles_monthly")
def _(t: Tables) -> DataFrame:
    return B.candles(t.clean_bars, "month")


@query("a9_candlestick_daily")
def _(t: Tables) -> DataFrame:
    m = t.marts
    return market.candlestick(m.cumulated, m.scored, B.latest(m.daily), "last_3_months", "day")


@query("a9_candlestick_weekly")
def _(t: Tables) -> DataFrame:
    m = t.marts
    return market.candlestick(m.cumulated, m.scored, B.latest(m.daily), "ytd", "week", "Mega Cap")


@query("a10_market_sentiment")
def _(t: Tables) -> DataFrame:
    m = t.marts
    return market.market_sentiment(
        B.month_end_changes(m.cumulated), TK.leading_tickers(m.scored), B.latest(m.daily)
    )


@query("a11_market_leader")
def _(t: Tables) -> DataFrame:
    m = t.marts
    return market.market_leader(
        B.month_end_changes(m.cumulated), TK.leading_tickers(m.scored), m.with_news, B.latest(m.daily)
    )


@query("a12_sector_performance")
def _(t: Tables) -> DataFrame:
    m = t.marts
    return market.sector_performance(B.month_end_changes(m.cumulated), m.enriched)


@query("a12_best_and_worst_sector")
def _(t: Tables) -> DataFrame:
    m = t.marts
    return market.best_and_worst_sector(
        market.sector_performance(B.month_end_changes(m.cumulated), m.enriched)
    )


@query("a13_best_and_worst_stock")
def _(t: Tables) -> DataFrame:
    return market.best_and_worst_stock(market.newest_movers(B.month_end_changes(t.marts.cumulated)))


@query("a14_watchlist")
def _(t: Tables) -> DataFrame:
    months = B.month_end_changes(t.marts.cumulated)
    # On generated dates few tickers trade on the very last day: take each
    # ticker's own newest change.
    movers = B.latest_changes(months).where(F.col("pct_change").isNotNull())
    return market.watchlist(movers, t.marts.enriched, WATCHED)


@query("a15_latest_date")
def _(t: Tables) -> DataFrame:
    return t.clean_bars.agg(F.max("date").alias("max_date"))


@query("a16_earnings_surprises", digits=4)
def _(t: Tables) -> DataFrame:
    return t.plain_marts.earnings


@query("a17_critical_counts")
def _(t: Tables) -> DataFrame:
    return validation.critical_counts(_errors(t, "sma", K.STRICT_ERROR_THRESHOLD), "sma")


@query("a17_critical_counts_by_day")
def _(t: Tables) -> DataFrame:
    return validation.critical_counts(_errors(t, "sma", K.STRICT_ERROR_THRESHOLD), "sma", by_day=True)


@query("a18_negative_totals", digits=2)
def _(t: Tables) -> DataFrame:
    payments = t.read("customer").select(F.col("c_nationkey").alias("id"), (F.col("c_acctbal") - 4500).alias("amount"))
    return quality.negative_totals(payments, "id", "amount")


def _errors(t: Tables, kind: str, threshold: float) -> DataFrame:
    """Errors against the vendor; bars of either side are derived once and stored."""
    bars = freeze(t.clean_bars.select("ticker", "date", "close"))
    calculated = {"sma": indicators.sma, "ema": indicators.ema, "wma": indicators.wma}[kind](bars)
    return validation.indicator_errors(t.vendor_values(kind, bars), calculated, kind, threshold=threshold)


@query("a19_sma_errors")
def _(t: Tables) -> DataFrame:
    return _errors(t, "sma", K.DAILY_ERROR_THRESHOLD)


@query("a19_ema_errors")
def _(t: Tables) -> DataFrame:
    return _errors(t, "ema", K.DAILY_ERROR_THRESHOLD)


@query("a19_wma_errors")
def _(t: Tables) -> DataFrame:
    return _errors(t, "wma", K.STRICT_ERROR_THRESHOLD)


@query("a20_vendor_consolidation")
def _(t: Tables) -> DataFrame:
    wide = t.vendor_values("sma")
    millis = (F.unix_date("timestamp").cast("bigint") * 86_400 + 14_400) * 1000
    long = wide.select("ticker", millis.alias("timestamp"), *[F.col(f"sma_{n}").alias(str(n)) for n in K.MA_WINDOWS])
    points = long.unpivot(["ticker", "timestamp"], [str(n) for n in K.MA_WINDOWS], "window", "value")
    points = points.where(F.col("value").isNotNull()).withColumn("window", F.col("window").cast("int"))
    return validation.consolidate_vendor(points, "sma")


@query("a21_surprise_return_correlation")
def _(t: Tables) -> DataFrame:
    return fundamentals.surprise_return_correlation(t.plain_marts.earnings, t.marts.daily, 5)


@query("a22_last_quarters")
def _(t: Tables) -> DataFrame:
    return fundamentals.last_quarters(t.plain_marts.earnings)


@query("a23_normalised_performance")
def _(t: Tables) -> DataFrame:
    return fundamentals.normalised_performance(t.plain_marts.earnings, t.marts.daily)


@query("a24_missing_values")
def _(t: Tables) -> DataFrame:
    return quality.missing_values(t.dirty_bars)


# Windows.


@query("w1_sma")
def _(t: Tables) -> DataFrame:
    return indicators.sma(t.clean_bars)


@query("w1_sma_mart")
def _(t: Tables) -> DataFrame:
    return t.marts.sma


@query("w2_wma")
def _(t: Tables) -> DataFrame:
    return indicators.wma(t.clean_bars)


@query("w3_ema")
def _(t: Tables) -> DataFrame:
    return indicators.ema(t.clean_bars)


@query("w4_macd")
def _(t: Tables) -> DataFrame:
    return indicators.macd(t.clean_bars)


def _gapped(t: Tables) -> DataFrame:
    """Bars in which some tickers miss a close, at the start, on a seed row or later."""
    numbered = t.clean_bars.withColumn("rn", F.row_number().over(indicators.by_date()))
    key = F.substring("ticker", 2, 20).cast("long")
    missing = (key % 3 == 0) & (F.col("rn") % 41 == key % 41)
    return numbered.withColumn("close", F.when(~missing, F.col("close"))).drop("rn")


@query("w2_wma_missing_closes")
def _(t: Tables) -> DataFrame:
    return indicators.wma(_gapped(t), windows=(5, 20), warm_only=False)


@query("w3_ema_missing_closes")
def _(t: Tables) -> DataFrame:
    return indicators.ema(_gapped(t))


_LOADS = ("1994-06-30", "1996-12-31", "1997-01-02")


def _loads(df: DataFrame) -> list[DataFrame]:
    """Rows by date in four loads, one of them a few days'."""
    edges = [None, *_LOADS, None]
    after = [df if a is None else df.where(F.col("date") > F.to_date(F.lit(a))) for a in edges[:-1]]
    return [d if b is None else d.where(F.col("date") <= F.to_date(F.lit(b))) for d, b in zip(after, edges[1:], strict=True)]


def _by_loads(df: DataFrame, extend) -> DataFrame:
    """Each load goes on from the stored state of the one before; the bars are derived once and stored."""
    state, parts = None, []
    for load in _loads(freeze(df.select("ticker", "date", "close"))):
        rows, state = extend(load, state)
        state = freeze(state)
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts)


@query("w3_ema_by_loads")
def _(t: Tables) -> DataFrame:
    return _by_loads(t.clean_bars, indicators.extend_ema)


@query("w3_ema_missing_closes_by_loads")
def _(t: Tables) -> DataFrame:
    return _by_loads(_gapped(t), indicators.extend_ema)


@query("w4_macd_by_loads")
def _(t: Tables) -> DataFrame:
    return _by_loads(t.clean_bars, indicators.extend_macd)


@query("w4_macd_missing_closes")
def _(t: Tables) -> DataFrame:
    return indicators.macd(_gapped(t))


@query("w5_bollinger")
def _(t: Tables) -> DataFrame:
    return indicators.bollinger(in_range(indicators.sma(t.clean_bars)))


@query("w6_recurrence")
def _(t: Tables) -> DataFrame:
    return indicators.ema(t.clean_bars, windows=(15,))


def _averages(t: Tables, kind: str) -> DataFrame:
    build = {"ema": indicators.ema, "sma": indicators.sma, "wma": indicators.wma}[kind]
    return in_range(build(t.clean_bars))


def _register_average_signals(kind: str) -> None:
    @query(f"w7_{kind}_signals")
    def _(t: Tables) -> DataFrame:
        return signals.moving_average_signals(_averages(t, kind), f"{kind}_20", kind)

    @query(f"w8_{kind}_signals_weekly")
    def _(t: Tables) -> DataFrame:
        return signals.moving_average_period_signals(_averages(t, kind), f"{kind}_20", kind, "week")

    @query(f"w8_{kind}_signals_monthly")
    def _(t: Tables) -> DataFrame:
        return signals.moving_average_period_signals(_averages(t, kind), f"{kind}_20", kind, "month")


for _kind in ("ema", "sma", "wma"):
    _register_average_signals(_kind)


@query("w8_ema_signals_week_numbers")
def _(t: Tables) -> DataFrame:
    return signals.moving_average_period_signals(_averages(t, "ema"), "ema_20", "ema", "week", week_number_order=True)


@query("w9_ranks", digits=2)
def _(t: Tables) -> DataFrame:
    return TK.rank_tickers(t.marts.scored).select(
        "ticker", "market_cap_category", "avg_daily_traded_value", "liquidity_rank_in_category", "overall_rank"
    )


def _register_band_signals(period: str, suffix: str) -> None:
    @query(f"w10_bollinger_signals_{suffix}")
    def _(t: Tables) -> DataFrame:
        bands = indicators.bollinger(in_range(indicators.sma(t.clean_bars)))
        return signals.bollinger_signals(bands, period)

    @query(f"w12_macd_signals_{suffix}")
    def _(t: Tables) -> DataFrame:
        return signals.macd_signals(in_range(indicators.macd(t.clean_bars)), period)


for _period, _suffix in (("day", "daily"), ("week", "weekly"), ("month", "monthly")):
    _register_band_signals(_period, _suffix)


@query("w11_month_end_changes")
def _(t: Tables) -> DataFrame:
    return B.month_end_changes(t.marts.cumulated)


@query("w12_macd_mega_caps")
def _(t: Tables) -> DataFrame:
    table = signals.macd_signals(in_range(indicators.macd(t.marts.daily)))
    return TK.in_category(table, t.marts.scored, "Mega Cap")


@query("w13_latest_news", digits=None)
def _(t: Tables) -> DataFrame:
    return TK.latest_news(t.news, 3)


@query("w14_first_bar_of_month")
def _(t: Tables) -> DataFrame:
    first = F.row_number().over(
        indicators.W.partitionBy("ticker", F.trunc("date", "month")).orderBy("date")
    )
    return t.clean_bars.withColumn("n", first).where(F.col("n") == 1).select("ticker", "date", "open")


@query("w15_first_and_last_value")
def _(t: Tables) -> DataFrame:
    return t.clean_bars.groupBy("ticker", F.year("date").alias("year")).agg(
        F.min_by("open", "date").alias("first_open"), F.max_by("close", "date").alias("last_close")
    )


@query("w16_best_and_worst_movers")
def _(t: Tables) -> DataFrame:
    movers = B.latest_changes(B.month_end_changes(t.marts.cumulated)).where(F.col("pct_change").isNotNull())
    return market.rank_movers(movers, 10)


@query("w17_out_of_order")
def _(t: Tables) -> DataFrame:
    from tickloom.operators.chunked import previous_row

    linked = previous_row(t.arrivals, "ticker", ["arrival"], ["date"], F.floor(F.col("arrival") / 10_000))
    return linked.where(F.col("date") < F.col("prev_date"))


@query("w18_golden_cross")
def _(t: Tables) -> DataFrame:
    return signals.cross_signal(
        indicators.sma(t.clean_bars).select("ticker", "date", "close", "sma_50", "sma_200"), "sma_50", "sma_200"
    ).where(F.col("signal").isNotNull())


# Sorts, top rows, unions.


@query("k1_ordered_ema")
def _(t: Tables) -> DataFrame:
    return indicators.ema(t.clean_bars, windows=(10,)).orderBy("ticker", "date")


@query("k2_top_rows")
def _(t: Tables) -> DataFrame:
    return t.clean_bars.orderBy(F.col("high").desc(), "ticker", "date").limit(10).select("ticker", "date", "high")


@query("k3_leading_tickers")
def _(t: Tables) -> DataFrame:
    return TK.leading_tickers(t.marts.scored)


@query("u1_surprise_union", digits=4)
def _(t: Tables) -> DataFrame:
    return t.marts.earnings


# Scalar functions.


@query("c1_grades_mart")
def _(t: Tables) -> DataFrame:
    return t.marts.grades


@query("c2_cents_to_dollars")
def _(t: Tables) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.read("orders").select("o_orderkey", C.cents_to_dollars(cents).alias("dollars"))


@query("c3_unpack_bars")
def _(t: Tables) -> DataFrame:
    return B.unpack_bars(t.marts.cumulated)


@query("c4_period_flags")
def _(t: Tables) -> DataFrame:
    return t.marts.candlesticks.select("ticker", "year", "month_num", F.size("bars").alias("days"), "is_current_month", "is_current_year")


# Streams.


def _parsed(t: Tables, delay: str | None = "1 hour") -> DataFrame:
    parsed = ticks.parse_ticks(t.tick_stream())
    return parsed.withWatermark("ts", delay) if delay else parsed


def _plain_time(df: DataFrame) -> DataFrame:
    """Event times without a zone, as the other engine keeps them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@query("r1_parse_ticks")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(_parsed(t, None), "parsed"))


@query("r2_series")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.series(ticks.keep_last(_parsed(t))), "series"))


@query("r3_latest_values")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.latest_values(_parsed(t, None)), "latest", ["symbol"]))


@query("r3_compacted_values")
def _(t: Tables) -> DataFrame:
    """Latest values of a stream whose versions are folded after each of four loads."""
    feed, out, progress = (scratch_path(t.spark, name) for name in ("feed", "versions", "versions-progress"))
    for load in range(4):
        t.tick_events.where(F.pmod(F.col("ingest_id"), F.lit(4)) == load).write.mode("append").parquet(feed)
        latest = ticks.latest_values(ticks.parse_ticks(t.spark.readStream.schema(t.tick_events.schema).parquet(feed)))
        sinks.upsert_batches(latest, out, progress).awaitTermination()
        sinks.compact_versions(t.spark, out, latest.schema, ["symbol"])
    return _plain_time(sinks.newest_versions(t.spark, out, latest.schema, ["symbol"]))


@query("r4_symbols")
def _(t: Tables) -> DataFrame:
    return sinks.run_to_end(ticks.symbols(_parsed(t, None)), "symbols")


@query("r4_symbol_sessions")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.symbol_sessions(_parsed(t), "1 day"), "sessions"))


@query("r5_update_messages")
def _(t: Tables) -> DataFrame:
    messages = sinks.run_to_end(ticks.update_messages(_parsed(t, None)), "updates")
    fields = "symbol string, price double, timestamp bigint, volume double, vwap double"
    return messages.select("channel", F.from_json("message", fields).alias("m")).select("channel", "m.*")


@query("r6_active_symbols")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.active_symbols_exact(_parsed(t), "6 hours"), "active"))


@query("r6_active_symbols_approximate")
def _(t: Tables) -> DataFrame:
    estimated = sinks.run_to_end(ticks.active_symbols(_parsed(t), "6 hours", relative_error=0.01), "active-approximate")
    exact = sinks.run_to_end(ticks.active_symbols_exact(_parsed(t), "6 hours"), "active")
    both = estimated.join(exact.withColumnRenamed("active_symbols", "exact"), ["window_start", "window_end"], "full")
    # Five standard deviations of the estimate.
    near = F.abs(F.col("active_symbols") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return _plain_time(both.select("window_start", "window_end", F.coalesce(near, F.lit(False)).alias("within_bound")))


@query("r6_active_symbols_sketches")
def _(t: Tables) -> DataFrame:
    """Symbols per 6 hours, day and week from the stored sketches of hours, near the exact numbers."""
    stored = sinks.run_to_end(ticks.symbol_sketches(_parsed(t), "1 hour"), "sketches")
    parsed = ticks.parse_ticks(t.tick_events)
    last = parsed.select(F.max("ts") - F.expr("INTERVAL 1 HOUR")).scalar()
    closed = parsed.where(F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR") <= last)
    parts = []
    for hours in (6, 24, 168):
        window = f"{hours} hours"
        exact = closed.groupBy(F.window("ts", window).alias("w")).agg(F.countDistinct("symbol").alias("exact"))
        exact = exact.select(F.col("w.start").alias("window_start"), "exact")
        both = ticks.active_from_sketches(stored, window).join(exact, "window_start", "full")
        # Five standard errors.
        near = F.abs(F.col("active_symbols") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("exact"))
        parts.append(both.select(F.lit(hours).alias("hours"), "window_start", "exact", F.coalesce(near, F.lit(False)).alias("within_bound")))
    return _plain_time(reduce(DataFrame.unionByName, parts))


@query("r7_message_rate")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.message_rate(_parsed(t), "6 hours", "1 hour"), "rates"))


@query("r8_velocity")
def _(t: Tables) -> DataFrame:
    return _plain_time(ticks.velocities(ticks.keep_last(ticks.parse_ticks(t.tick_events))))


@query("r8_velocity_stream")
def _(t: Tables) -> DataFrame:
    return _plain_time(velocities_to_end(_parsed(t), "1 hour"))


@query("r9_velocity_alerts_stream")
def _(t: Tables) -> DataFrame:
    return _plain_time(velocities_to_end(_parsed(t), "1 hour", alerts_only=True))


@query("r9_velocity_alerts")
def _(t: Tables) -> DataFrame:
    velocity = ticks.velocities(ticks.keep_last(ticks.parse_ticks(t.tick_events)))
    return _plain_time(ticks.velocity_alerts(velocity))


@query("r10_retention")
def _(t: Tables) -> DataFrame:
    recent = ticks.parse_ticks(t.tick_events)
    newest = recent.select(F.max("ts")).scalar()
    kept = recent.where(F.col("ts") >= newest - F.expr(f"INTERVAL {K.VELOCITY_RETENTION}"))
    return _plain_time(kept.select("symbol", "ts", "close", "ingest_id"))


@query("r11_keep_last")
def _(t: Tables) -> DataFrame:
    kept = ticks.keep_last(_parsed(t)).select("symbol", "ts", "close", "ingest_id")
    return _plain_time(sinks.run_to_end(kept, "last"))


@query("r12_tick_candles")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.tick_candles(ticks.keep_last(_parsed(t)), "6 hours"), "candles"))


@query("r13_tick_moving_average")
def _(t: Tables) -> DataFrame:
    return _plain_time(sinks.run_to_end(ticks.tick_moving_average(ticks.keep_last(_parsed(t)), "6 hours", "2 hours"), "averages"))


@query("r13_last_points")
def _(t: Tables) -> DataFrame:
    kept = ticks.keep_last(ticks.parse_ticks(t.tick_events))
    return _plain_time(ticks.last_points_average(kept, 20).select("symbol", "ts", "ingest_id", "average", "ticks"))


@query("r13_last_points_stream")
def _(t: Tables) -> DataFrame:
    """Averages of the last 20 points over five loads of a stream; ticks come up to ten days out of order."""
    feed, out, progress = (scratch_path(t.spark, name) for name in ("feed", "last-points", "last-points-progress"))
    came = F.col("start_timestamp") + F.pmod(F.xxhash64("ingest_id"), F.lit(864_000_000))
    events = t.tick_events.withColumn("came", came)
    ends = events.select(F.struct(F.min("came").alias("first"), F.max("came").alias("last"))).scalar()
    share = (F.col("came") - ends.getField("first")) / (ends.getField("last") - ends.getField("first") + 1)
    for load in range(5):
        events.where(F.floor(share * 5) == load).drop("came").write.mode("append").parquet(feed)
        parsed = ticks.parse_ticks(t.spark.readStream.schema(t.tick_events.schema).parquet(feed))
        points.start_last_points(parsed, out, progress, 20, "20 days").awaitTermination()
    return _plain_time(points.read_last_points(t.spark, out).select("symbol", "ts", "ingest_id", "average", "ticks"))


@query("r14_flush_groups")
def _(t: Tables) -> DataFrame:
    """Events released over two runs of a stream: each once, in groups of a hundred at most."""
    feed, out, progress = (scratch_path(t.spark, name) for name in ("feed", "groups", "groups-progress"))
    for half in range(2):
        t.tick_events.where(F.col("ingest_id") % 2 == half).write.mode("append").parquet(feed)
        parsed = ticks.parse_ticks(t.spark.readStream.schema(t.tick_events.schema).parquet(feed))
        sinks.flush_groups(parsed, out, progress).awaitTermination()
    groups = t.spark.read.parquet(out).groupBy("batch_id", "task", "part", "symbol").agg(F.count("*").alias("n"))
    sizes = groups.groupBy("batch_id", "task", "part").agg(F.sum("n").alias("size"))
    per_symbol = groups.groupBy("symbol").agg(F.sum("n").alias("events"))
    return per_symbol.withColumn("within", sizes.select(F.max("size") <= K.FLUSH_EVENTS).scalar())


def _routed(t: Tables, kind: str, retention: str | None = None, remove: bool = False) -> DataFrame:
    """The events as a stream of five batches, late ticks apart; ``remove`` deletes what the retention has passed."""
    feed, out, progress = (scratch_path(t.spark, name) for name in ("feed", "routed", "routed-progress"))
    number = F.floor((F.col("ingest_id") - 1) / 2)
    for batch in range(5):
        # All files written since the last run are one batch.
        t.tick_events.where(number % 5 == batch).write.mode("append").parquet(feed)
        parsed = ticks.parse_ticks(t.spark.readStream.schema(t.tick_events.schema).parquet(feed))
        late.keep_late_apart(parsed, out, progress, "20 days", retention, per="day").awaitTermination()
        if remove:
            late.remove_expired(t.spark, out, retention, "day")
    return late.read_routed(t.spark, out, kind, parsed.schema)


@query("r10_retention_stream")
def _(t: Tables) -> DataFrame:
    return _plain_time(_routed(t, "timely", "25 days").select("symbol", "ts", "close", "ingest_id"))


@query("r10_retention_removed")
def _(t: Tables) -> DataFrame:
    return _plain_time(_routed(t, "timely", "25 days", remove=True).select("symbol", "ts", "close", "ingest_id"))


@query("r15_late_ticks_stream")
def _(t: Tables) -> DataFrame:
    return _routed(t, "late").groupBy("symbol").agg(F.count("*").alias("late"))


@query("r15_late_ticks")
def _(t: Tables) -> DataFrame:
    late = ticks.late_ticks(ticks.parse_ticks(t.tick_events), "20 days")
    return late.groupBy("symbol").agg(F.count("*").alias("late"))


# Data quality.


@query("q1_volume_checks")
def _(t: Tables) -> DataFrame:
    return quality.volume_checks(t.dirty_bars)


@query("q2_price_checks")
def _(t: Tables) -> DataFrame:
    return quality.price_checks(t.dirty_bars)


@query("q3_timestamp_checks")
def _(t: Tables) -> DataFrame:
    return quality.timestamp_checks(t.arrivals, "arrival", 10_000)


@query("q4_completeness")
def _(t: Tables) -> DataFrame:
    return quality.ticker_completeness(t.clean_bars)


@query("q4_completeness_of_all")
def _(t: Tables) -> DataFrame:
    return quality.ticker_completeness(t.clean_bars, of_all_records=True)


@query("q5_outliers")
def _(t: Tables) -> DataFrame:
    return quality.outliers(t.clean_bars)


@query("q5_outliers_of_loads")
def _(t: Tables) -> DataFrame:
    """Outliers from profiles of days, taken load by load; bars are read again only where a bound goes through a bucket."""
    path, kept = scratch_path(t.spark, "profiled-bars"), scratch_path(t.spark, "profiles")
    bars = t.clean_bars.withColumn("year", F.year("date"))
    bars.hint("rebalance", F.col("year")).write.partitionBy("year").parquet(path)
    stored = t.spark.read.schema(bars.schema).parquet(path)
    for load in (F.col("year") < 1996, F.col("year") >= 1996):
        profiles.value_profile(stored.where(load), "date").write.mode("append").parquet(kept)
    return profiles.outliers_from_profile(t.spark.read.parquet(kept), stored, "date")


@query("q6_null_percentages")
def _(t: Tables) -> DataFrame:
    return quality.null_percentages(t.dirty_bars)


@query("q7_load_gate")
def _(t: Tables) -> DataFrame:
    return quality.load_gate(t.dirty_bars)


@query("q8_not_null")
def _(t: Tables) -> DataFrame:
    return quality.not_null(t.dirty_bars, "close").select("ticker", "date", "open")


@query("q8_unique")
def _(t: Tables) -> DataFrame:
    return quality.unique(t.tickers, "ticker")


@query("q8_accepted_values")
def _(t: Tables) -> DataFrame:
    return quality.accepted_values(t.grades, "newGrade", ("Hold", "Strong Buy"))


@query("q9_compound_unique")
def _(t: Tables) -> DataFrame:
    return quality.unique(t.grades, "ticker", "date", "gradingCompany")


@query("q10_at_least")
def _(t: Tables) -> DataFrame:
    return quality.at_least(t.dirty_bars, "high", "low").select("ticker", "date", "high", "low")


@query("q11_is_positive")
def _(t: Tables) -> DataFrame:
    return quality.is_positive(t.dirty_bars.select("ticker", "date", "volume"), "volume", "warn")


@query("q11_is_even")
def _(t: Tables) -> DataFrame:
    return quality.is_even(t.clean_bars.select("ticker", "date", "transactions"), "transactions")


@query("q11_is_odd")
def _(t: Tables) -> DataFrame:
    return quality.is_odd(t.clean_bars.select("ticker", "date", "transactions"), "transactions")


@query("q12_array_not_empty")
def _(t: Tables) -> DataFrame:
    months = t.marts.cumulated.withColumn("bars", F.filter("bars", lambda b: F.day(b["date"]) <= 10))
    return quality.array_not_empty(months, "bars").select("ticker", "year", "month_num")


@query("q13_value_length")
def _(t: Tables) -> DataFrame:
    return quality.value_length_between(t.marts.cumulated, "record_count", 2, 31).select(
        "ticker", "year", "month_num", "record_count"
    )


@query("q14_critical_yesterday")
def _(t: Tables) -> DataFrame:
    return validation.critical_yesterday(_errors(t, "sma", K.DAILY_ERROR_THRESHOLD), "sma")


@query("q15_fill_calendar")
def _(t: Tables) -> DataFrame:
    return quality.fill_calendar(t.clean_bars)


@query("q16_price_jumps")
def _(t: Tables) -> DataFrame:
    return quality.price_jumps(t.clean_bars, 50.0)


# Dashboard questions, end to end.


@query("d1_moving_average_weekly")
def _(t: Tables) -> DataFrame:
    return serving.moving_average(t.marts, "ema", *RANGE, window=50, aggregation="weekly", category="Large Cap")


@query("d2_bollinger_daily")
def _(t: Tables) -> DataFrame:
    return serving.bollinger(t.marts, *RANGE)


@query("d3_macd_monthly")
def _(t: Tables) -> DataFrame:
    return serving.macd(t.marts, *RANGE, aggregation="monthly")


@query("d4_dashboard")
def _(t: Tables) -> DataFrame:
    row = serving.market_dashboard(t.marts, B.latest(t.marts.daily), WATCHED)
    return row.select(
        "market_sentiment",
        F.col("leader.ticker").alias("leader_ticker"),
        F.col("leader.change_pct").alias("leader_change"),
        F.col("hottest_sector.name").alias("hottest_sector"),
        F.col("worst_sector.name").alias("worst_sector"),
        F.col("top_stock.ticker").alias("top_stock"),
        F.col("worst_stock.ticker").alias("worst_stock"),
        F.size("market_summary").alias("watched"),
    )


def _calendar_marts(t: Tables) -> Marts:
    """Adjusted bars, and earnings of the calendar alone."""
    marts = Marts(t, apply_split_adjustment=True)
    marts.__dict__["earnings"] = t.plain_marts.earnings
    return marts


@query("d5_eps_surprises")
def _(t: Tables) -> DataFrame:
    return serving.eps_surprises(_calendar_marts(t), category="Mega Cap")


@query("d6_eps_performance")
def _(t: Tables) -> DataFrame:
    return serving.eps_performance(_calendar_marts(t), quarter=2, year=1997)


@query("d7_eps_correlation")
def _(t: Tables) -> DataFrame:
    return serving.eps_correlation(_calendar_marts(t), return_days=3)


@query("d8_candlestick_weekly")
def _(t: Tables) -> DataFrame:
    return serving.candlestick(t.marts, "last_1_year", "weekly")


@query("d9_sma_daily")
def _(t: Tables) -> DataFrame:
    return serving.moving_average(t.marts, "sma", *RANGE, window=20)
