"""First step after loading: drop unusable rows, keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """Keep the smallest row of every key.

    Done as an aggregate and not as a row number, so each map task already
    reduces a hot key to a single row before anything is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return picked.select(*keys, "row.*").select(*df.columns)


def stage_tickers(tickers: DataFrame) -> DataFrame:
    """Listed stocks of a known type, one row per ticker."""
    usable = tickers.where((F.col("market") == "stocks") & F.col("type").isNotNull())
    return one_row_per_key(usable, "ticker")


def stage_ticker_details(details: DataFrame) -> DataFrame:
    """Details with an industry code and a type, one row per ticker."""
    return one_row_per_key(details.dropna(subset=["sic_code", "type"]), "ticker")


def stage_bars(bars: DataFrame, staged_tickers: DataFrame) -> DataFrame:
    """Bars that were traded, of known tickers only."""
    traded = bars.where((F.col("volume") > 0) & (F.col("transactions") > 0))
    return traded.join(staged_tickers.select("ticker"), "ticker", "left_semi")


def stage_splits(splits: DataFrame) -> DataFrame:
    """Splits with a usable ratio."""
    return splits.where((F.col("split_to") > 0) & (F.col("split_from") != 0))


def stage_earnings_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.dropna(subset=["epsActual", "epsEstimate", "revenueActual", "revenueEstimate"])


def stage_earnings_surprises(surprises: DataFrame) -> DataFrame:
    return surprises.dropna(subset=["actual", "estimate", "surprise", "surprisePercent"])


def stage_grades(grades: DataFrame) -> DataFrame:
    return grades.distinct()


def stage_exchanges(exchanges: DataFrame) -> DataFrame:
    return exchanges.where(F.col("asset_class") == "stocks")


def stage_news(news: DataFrame) -> DataFrame:
    return news


def stage_sic_codes(sic_codes: DataFrame) -> DataFrame:
    return sic_codes
