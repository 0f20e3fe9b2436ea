"""Reference data of tickers: enrichment, classification, latest news."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.functions.columns import liquidity_score, market_cap_category, market_cap_order
from tickloom.operators.ranking import global_rank
from tickloom.session import freeze

ENRICHED_COLUMNS = (
    "ticker", "name", "active", "sic_code", "sic_description", "office", "industry", "market_cap",
    "branding_icon_url", "branding_logo_url", "share_class_shares_outstanding",
    "weighted_shares_outstanding", "primary_exchange", "total_employees",
)


def enrich_tickers(tickers: DataFrame, details: DataFrame, sic_codes: DataFrame) -> DataFrame:
    """Tickers with their details and industry; all three must match.

    No join is forced to broadcast: the optimizer does so by size, and falls
    back to a shuffled join when a side has outgrown memory.
    """
    industry = sic_codes.select(F.col("code").cast("int").alias("_code"), "office", "industry")
    return (
        tickers.select("ticker", "name", "active")
        .join(details.drop("name", "type", "rn"), "ticker")
        .join(industry, F.col("sic_code").try_cast("int") == F.col("_code"))
        .select(*ENRICHED_COLUMNS)
    )


def liquidity(bars: DataFrame, latest_date: Column, months: int = K.LIQUIDITY_MONTHS) -> DataFrame:
    """Volume and traded value of every ticker over the last months.

    Takes plain bars: the condition on the date then reaches the scan, and
    older bars are not read.
    """
    recent = bars.where(F.col("date") >= F.add_months(latest_date, -months))
    traded = F.col("volume") * F.col("close")
    return recent.groupBy("ticker").agg(
        F.avg("volume").alias("avg_daily_volume"),
        F.avg(traded).alias("avg_daily_traded_value"),
        F.min(traded).alias("min_daily_traded_value"),
        F.max(traded).alias("max_daily_traded_value"),
    )


def score_tickers(liquidity_metrics: DataFrame, enriched: DataFrame) -> DataFrame:
    """Liquidity of all tickers with category and score; unknown ones stay."""
    details = enriched.select(
        "ticker", "market_cap", "name", "office", "industry",
        "branding_icon_url", "branding_logo_url", "primary_exchange",
    )
    return liquidity_metrics.join(details, "ticker", "left").withColumns(
        {
            "market_cap_category": market_cap_category(F.col("market_cap")),
            "liquidity_score": liquidity_score(F.col("avg_daily_traded_value")),
        }
    )


def overall_score() -> Column:
    return (
        F.col("market_cap") * K.RANK_WEIGHT_CAP + F.col("avg_daily_traded_value") * K.RANK_WEIGHT_LIQUIDITY
    )


def reliable(scored: DataFrame) -> DataFrame:
    """Tickers that are liquid and large enough to rely on."""
    return scored.where(
        (F.col("liquidity_score") >= K.RELIABLE_MIN_SCORE)
        & (F.col("market_cap") >= K.RELIABLE_MIN_CAP)
        & (F.col("avg_daily_volume") > K.RELIABLE_MIN_VOLUME)
    )


def rank_tickers(scored: DataFrame) -> DataFrame:
    """Rank in category and overall rank over all tickers, before any filter.

    An unknown cap makes the overall score unknown, which ranks first.  The
    scores, one row per ticker, are stored once and not derived from the bars
    again for either rank.
    """
    scored = freeze(scored)
    ranked = global_rank(scored, F.col("avg_daily_traded_value"), "liquidity_rank_in_category", ["market_cap_category"])
    return global_rank(ranked, overall_score(), "overall_rank")


def classify_tickers(scored: DataFrame) -> DataFrame:
    """Reliable tickers with their ranks, amounts in billions and millions."""
    return reliable(rank_tickers(scored)).select(
        "ticker",
        "name",
        "overall_rank",
        "market_cap_category",
        F.round(F.col("market_cap") / 1_000_000_000, 2).alias("market_cap_billions"),
        F.round("avg_daily_volume", 0).alias("avg_daily_volume"),
        F.round(F.col("avg_daily_traded_value") / 1_000_000, 2).alias("avg_daily_traded_value_millions"),
        "liquidity_score",
        "liquidity_rank_in_category",
        "office",
        "industry",
        "branding_icon_url",
        "branding_logo_url",
        "primary_exchange",
    )


def leading_tickers(scored: DataFrame, count: int = K.LEADING_TICKERS) -> DataFrame:
    """The best-ranked reliable tickers.

    Ordering by the score gives the order of the ranks, so no rank is computed
    and Spark keeps only the best rows of each task.
    """
    best_first = [overall_score().desc(), F.col("ticker").asc()]
    return reliable(scored).orderBy(*best_first).limit(count).select("ticker", "market_cap_category")


def in_category(df: DataFrame, scored: DataFrame, category: str | None = None) -> DataFrame:
    """Rows of reliable tickers with their category, of one category if named."""
    chosen = reliable(scored).select("ticker", "market_cap_category")
    if category:
        chosen = chosen.where(F.col("market_cap_category") == category)
    return df.join(chosen, "ticker")


def category_list(scored: DataFrame) -> DataFrame:
    """Categories that occur, largest first."""
    name = F.col("market_cap_category")
    return reliable(scored).select(name).distinct().orderBy(market_cap_order(name))


def ticker_picker(classified: DataFrame, category: str | None = "Mega Cap") -> DataFrame:
    """Entries of a ticker menu: of one category by liquidity, or all by name."""
    entry = [F.concat_ws(" - ", "ticker", F.coalesce("name", F.lit("None"))).alias("text"), F.col("ticker").alias("value")]
    if not category:
        return classified.orderBy("ticker").select(*entry)
    chosen = classified.where(F.col("market_cap_category") == category)
    return chosen.orderBy("liquidity_rank_in_category", "ticker").select(*entry)


def latest_news(news: DataFrame, count: int) -> DataFrame:
    """The newest items of every ticker, numbered from 1.

    Spark evaluates the limit on the row number in the map tasks as well, so a
    ticker with very much news sends only ``count`` rows per task.
    """
    newest = W.partitionBy("ticker").orderBy(F.col("date").desc_nulls_first(), F.col("article_url"))
    return news.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= count)


def current_and_previous(news: DataFrame) -> DataFrame:
    """Sentiment of the two newest items as two columns, with date and reasoning."""
    def pick(column: str, rn: int) -> Column:
        return F.max(F.when(F.col("rn") == rn, F.col(column)))

    return latest_news(news, 2).groupBy("ticker").agg(
        pick("sentiment", 1).alias("current_sentiment"),
        pick("sentiment", 2).alias("previous_sentiment"),
        pick("date", 1).alias("date"),
        pick("sentiment_reasoning", 1).alias("current_reasoning"),
    )


def tickers_with_news(enriched: DataFrame, news: DataFrame) -> DataFrame:
    """Enriched tickers that have news, with their two latest sentiments."""
    return enriched.join(current_and_previous(news), "ticker")


def pivot_sentiments(enriched: DataFrame, news: DataFrame) -> DataFrame:
    """Enriched tickers with one column per news position."""
    items = latest_news(news, 2).select("ticker", "rn", "sentiment")
    positions = items.groupBy("ticker").pivot("rn", [1, 2]).agg(F.max("sentiment"))
    return enriched.join(
        positions.select(
            "ticker", F.col("1").alias("current_sentiment"), F.col("2").alias("previous_sentiment")
        ),
        "ticker",
    )


def not_yet_graded(
    classified: DataFrame,
    grades: DataFrame,
    exclude: tuple[str, ...] = (),
    min_rank: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Classified tickers without any grade, in rank order."""
    graded = grades.select("ticker").where(F.col("ticker").isNotNull())
    open_ = classified.join(graded, "ticker", "left_anti")
    if exclude:
        open_ = open_.where(~F.col("ticker").isin(*exclude))
    if min_rank is not None:
        open_ = open_.where(F.col("overall_rank") >= min_rank)
    ordered = open_.select("ticker", "overall_rank").orderBy("overall_rank", "ticker")
    return ordered if limit is None else ordered.limit(limit)
