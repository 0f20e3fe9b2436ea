"""Raw responses into tables.

Every function takes a DataFrame with one JSON document per row, or its parsed
items, and returns typed columns.  Missing fields become NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.columns import date_from_millis


def parse(documents: DataFrame, schema, column: str = "value") -> DataFrame:
    """JSON text into columns; broken documents yield NULL fields."""
    return documents.select(F.from_json(column, schema).alias("item")).select("item.*")


def normalize_daily_json(documents: DataFrame) -> DataFrame:
    """Grouped daily responses into bars."""
    # Two fields differ in case only, so they are renamed by position.
    fields = ("ticker", "volume", "open", "close", "high", "low", "_millis", "transactions")
    rows = parse(documents, schemas.DAILY_RESPONSE).select(F.inline("results").alias(*fields))
    return rows.withColumn("date", date_from_millis(F.col("_millis"))).select(
        "ticker", "volume", "open", "close", "high", "low", "date", "transactions"
    )


def parse_ticker_details(documents: DataFrame) -> DataFrame:
    """Maps from ticker to details into one flat row per ticker."""
    entries = documents.select(F.explode(F.from_json("value", schemas.TICKER_DETAIL_MAP)).alias("ticker", "entry"))
    details = F.col("entry.results")
    return entries.select(
        "ticker",
        details["type"].alias("type"),
        details["market_cap"].alias("market_cap"),
        details["sic_code"].alias("sic_code"),
        details["sic_description"].alias("sic_description"),
        details["branding"]["icon_url"].alias("branding_icon_url"),
        details["branding"]["logo_url"].alias("branding_logo_url"),
        details["total_employees"].alias("total_employees"),
        details["name"].alias("name"),
        details["share_class_shares_outstanding"].alias("share_class_shares_outstanding"),
        details["weighted_shares_outstanding"].alias("weighted_shares_outstanding"),
        details["primary_exchange"].alias("primary_exchange"),
    )


def flatten_news(items: DataFrame) -> DataFrame:
    """News items with their first insight; without insights these are NULL."""
    first = F.try_element_at("insights", F.lit(1))
    return items.select(
        first["ticker"].alias("ticker"),
        first["sentiment"].alias("sentiment"),
        first["sentiment_reasoning"].alias("sentiment_reasoning"),
        F.to_date(F.substring("published_utc", 1, 10)).alias("date"),
        "article_url",
    )


def map_earnings(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("symbol").alias("ticker"),
        "year",
        F.to_date("date").alias("date"),
        "hour",
        "quarter",
        "epsActual",
        "epsEstimate",
        "revenueActual",
        "revenueEstimate",
    )


def map_surprises(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("symbol").alias("ticker"),
        "year",
        F.to_date("period").alias("date"),
        "quarter",
        "actual",
        "estimate",
        "surprise",
        "surprisePercent",
    )


def map_grades(items: DataFrame) -> DataFrame:
    """Grades; items without a symbol are skipped."""
    return items.where(F.col("symbol").isNotNull()).select(
        F.col("symbol").alias("ticker"),
        F.to_date("date").alias("date"),
        "gradingCompany",
        "previousGrade",
        "newGrade",
        "action",
    )


def map_splits(items: DataFrame) -> DataFrame:
    return items.select(
        "ticker",
        F.col("split_from").try_cast("int").alias("split_from"),
        F.col("split_to").try_cast("int").alias("split_to"),
        F.to_date("execution_date").alias("date"),
    )


def map_exchanges(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("id").cast("int").alias("id"),
        "type", "asset_class", "locale", "name", "operating_mic", "participant_id", "url",
    )


def map_tickers(items: DataFrame) -> DataFrame:
    return items.select("ticker", "name", "market", "type", F.col("active").cast("boolean").alias("active"))
