"""Market overview: mood, leader, sectors, movers, watchlist, trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.functions.columns import percent_change, within_period
from tickloom.operators.bars import BAR_FIELDS, candles, latest, latest_changes, unpack_bars
from tickloom.operators.tickers import in_category


def recent_months(month_changes: DataFrame, as_of: Column) -> DataFrame:
    """Rows of the month of a date and of the month before it."""
    month = F.make_date("year", "month_num", F.lit(1))
    this_month = F.trunc(as_of, "month")
    return month_changes.where((month <= this_month) & (month >= F.add_months(this_month, -1)))


def market_sentiment(month_changes: DataFrame, leaders: DataFrame, as_of: Column) -> DataFrame:
    """Bullish if more leading tickers rose than fell, else Bearish."""
    newest = latest_changes(recent_months(month_changes, as_of).join(leaders.select("ticker"), "ticker", "left_semi"))
    direction = F.signum(F.coalesce(F.col("close") - F.col("prev_close"), F.lit(0.0)))
    score = F.coalesce(F.sum(direction).cast("bigint"), F.lit(0))
    return newest.agg(score.alias("score")).select(
        "score", F.when(F.col("score") > 0, "Bullish").otherwise("Bearish").alias("market_sentiment")
    )


def market_leader(
    month_changes: DataFrame, leaders: DataFrame, with_news: DataFrame, as_of: Column
) -> DataFrame:
    """The leading ticker with the best change, with sentiment and branding."""
    newest = latest_changes(recent_months(month_changes, as_of).join(leaders.select("ticker"), "ticker", "left_semi"))
    best = (
        newest.where(F.col("pct_change").isNotNull())
        .orderBy(F.col("pct_change").desc(), "ticker")
        .limit(1)
        .select("ticker", "close", "pct_change")
    )
    facts = with_news.select("ticker", "current_sentiment", "branding_logo_url", "branding_icon_url")
    return best.join(facts, "ticker", "left")


def sector_performance(month_changes: DataFrame, enriched: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Average change per industry over all month rows of the year of a date, or of the last year on file.

    The last year comes from the sums themselves, a row per industry and year,
    so the months are derived once.
    """
    change = percent_change(F.col("close"), F.col("prev_close"))
    industry = enriched.where(F.col("industry").isNotNull()).select("ticker", F.col("industry").alias("sector"))
    months = month_changes.select("ticker", "year", change.alias("change"))
    if as_of is not None:
        months = months.where(F.col("year") == F.year(as_of))
    years = months.join(industry, "ticker", "left").groupBy("sector", "year").agg(F.avg("change").alias("avg_change_pct"))
    if as_of is None:
        years = years.withColumn("newest", F.max("year").over(W.partitionBy())).where("year = newest")
    return years.where("sector IS NOT NULL AND avg_change_pct IS NOT NULL").select("sector", "avg_change_pct")


def best_and_worst_sector(sectors: DataFrame) -> DataFrame:
    """Hottest and worst sector in one row; ties go to the first name."""
    high = F.min_by("sector", F.struct((-F.col("avg_change_pct")).alias("rank"), F.col("sector").alias("tie")))
    low = F.min_by("sector", F.struct(F.col("avg_change_pct").alias("rank"), F.col("sector").alias("tie")))
    return sectors.agg(
        high.alias("hottest_sector"),
        F.max("avg_change_pct").alias("hottest_sector_change"),
        low.alias("worst_sector"),
        F.min("avg_change_pct").alias("worst_sector_change"),
    )


def newest_movers(month_changes: DataFrame) -> DataFrame:
    """Change of every ticker that traded on the last day on file."""
    on_last_day = month_changes.where(F.col("last_date") == latest(month_changes, "last_date"))
    return latest_changes(on_last_day).where(F.col("pct_change").isNotNull())


def best_and_worst_stock(movers: DataFrame) -> DataFrame:
    """Top and worst stock in one row; ties go to the first ticker."""
    row = F.struct("ticker", "close", "pct_change")
    top = F.min_by(row, F.struct((-F.col("pct_change")).alias("rank"), F.col("ticker").alias("tie")))
    worst = F.min_by(row, F.struct(F.col("pct_change").alias("rank"), F.col("ticker").alias("tie")))
    return movers.agg(top.alias("top"), worst.alias("worst")).select(
        *[
            F.col(f"{end}.{field}").alias(f"{end}_stock_{name}")
            for end in ("top", "worst")
            for field, name in (("ticker", "ticker"), ("close", "price"), ("pct_change", "change"))
        ]
    )


def rank_movers(movers: DataFrame, count: int) -> DataFrame:
    """The best and the worst movers, numbered from 1 at either end."""
    def end(order: Column, name: str) -> DataFrame:
        # At most `count` rows reach this numbering.
        rows = movers.orderBy(order, "ticker").limit(count)
        listed = rows.agg(
            F.array_sort(F.collect_list(F.struct((F.col("pct_change") * sign[name]).alias("key"), "ticker"))).alias("l")
        )
        return listed.select(F.posexplode("l").alias("pos", "item")).select(
            F.lit(name).alias("side"),
            (F.col("pos") + 1).alias("position"),
            F.col("item.ticker").alias("ticker"),
            (F.col("item.key") * sign[name]).alias("pct_change"),
        )

    sign = {"best": -1.0, "worst": 1.0}
    return end(F.col("pct_change").desc(), "best").unionByName(end(F.col("pct_change").asc(), "worst"))


def watchlist(movers: DataFrame, enriched: DataFrame, symbols: Sequence[str] = K.WATCHLIST) -> DataFrame:
    """Price, change and direction of chosen tickers, in order of ticker."""
    price, before = F.col("close"), F.col("prev_close")
    chosen = movers.where(F.col("ticker").isin(*symbols))
    facts = enriched.select("ticker", "name", "branding_icon_url", "branding_logo_url")
    return (
        chosen.join(facts, "ticker", "left")
        .select(
            "ticker",
            "name",
            "branding_icon_url",
            "branding_logo_url",
            price.alias("price"),
            F.col("pct_change").alias("change_pct"),
            F.when(price > before, "up").when(price < before, "down").otherwise("unchanged").alias("direction"),
        )
        .orderBy("ticker")
    )


def filter_period(bars: DataFrame, period: str | None, latest_date: Column) -> DataFrame:
    return bars.where(within_period(F.col("date"), latest_date, period))


def filter_dates(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows between two dates, both included."""
    return df.where(F.col("date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def candlestick(
    cumulated: DataFrame,
    scored: DataFrame,
    latest_date: Column,
    period: str | None = "last_5_days",
    aggregation: str = "day",
    category: str | None = None,
    ticker: str | None = None,
) -> DataFrame:
    """Candles of reliable tickers in a period; of one ticker if named."""
    if ticker:
        cumulated = cumulated.where(F.col("ticker") == ticker)
        scored = scored.where(F.col("ticker") == ticker)
    bars = filter_period(unpack_bars(cumulated).select("ticker", *BAR_FIELDS), period, latest_date)
    return in_category(candles(bars, aggregation), scored, category)


def stock_trend(
    bars: DataFrame, as_of: Column, ticker: str | None = K.DEFAULT_TICKER, days: int | str = K.DEFAULT_TREND_DAYS
) -> DataFrame:
    """Complete bars of the last calendar days, of one ticker or of all (None).

    A number of days that is not positive, or no number, counts as the default.
    """
    try:
        days = int(days)
    except (TypeError, ValueError):
        days = K.DEFAULT_TREND_DAYS
    if days <= 0:
        days = K.DEFAULT_TREND_DAYS
    chosen = bars if ticker is None else bars.where(F.col("ticker") == ticker)
    recent = chosen.where(F.col("date") >= F.date_sub(as_of, days))
    fields = ["ticker", "date", "open", "high", "low", "close"]
    return recent.dropna(subset=fields).select(*fields).orderBy("ticker", "date")


def stock_info(classified: DataFrame, ticker: str | None = K.DEFAULT_TICKER) -> DataFrame:
    """What the classification knows about one ticker, or about all (None)."""
    chosen = classified if ticker is None else classified.where(F.col("ticker") == ticker)
    return chosen.select(
        "ticker", "name", "industry", "office", "avg_daily_volume", "avg_daily_traded_value_millions",
        "liquidity_score", "market_cap_category", "branding_icon_url", "branding_logo_url", "primary_exchange",
    )
