"""Earnings and analyst grades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.columns import classify_grade

SURPRISE_COLUMNS = (
    "ticker", "year", "date", "quarter", "epsActual", "epsEstimate", "epsSurprise",
    "epsSurprisePercent", "revenueSurprise", "revenueSurprisePercent", "row_num",
)


def calendar_surprises(calendar: DataFrame) -> DataFrame:
    """Surprises of the earnings calendar; a zero estimate has no percentage."""
    sequence = W.partitionBy("ticker").orderBy(F.col("date").asc_nulls_last(), F.col("quarter").desc_nulls_first())
    eps = F.col("epsActual") - F.col("epsEstimate")
    revenue = F.col("revenueActual") - F.col("revenueEstimate")
    base = F.when(F.col("revenueEstimate") == 0, F.lit(1)).otherwise(F.col("revenueEstimate"))
    return (
        calendar.where(F.col("epsEstimate") != 0)
        .withColumns(
            {
                "row_num": F.row_number().over(sequence),
                "epsSurprise": eps,
                "epsSurprisePercent": eps / F.abs("epsEstimate") * 100,
                "revenueSurprise": revenue,
                "revenueSurprisePercent": revenue / F.abs(base) * 100,
            }
        )
        .select(*SURPRISE_COLUMNS)
    )


def historic_surprises(surprises: DataFrame) -> DataFrame:
    """Surprises of the history in the same shape; revenue is not known there."""
    newest = W.partitionBy("ticker").orderBy(F.col("date").desc_nulls_first(), F.col("quarter").desc_nulls_first())
    return surprises.select(
        "ticker",
        "year",
        "date",
        "quarter",
        F.col("actual").alias("epsActual"),
        F.col("estimate").alias("epsEstimate"),
        F.col("surprise").alias("epsSurprise"),
        F.col("surprisePercent").alias("epsSurprisePercent"),
        F.lit(None).cast("bigint").alias("revenueSurprise"),
        F.lit(None).cast("double").alias("revenueSurprisePercent"),
        F.row_number().over(newest).alias("row_num"),
    )


def earnings_surprises(calendar: DataFrame, surprises: DataFrame | None = None) -> DataFrame:
    """Surprises of the calendar, and of the history where it is wanted."""
    current = calendar_surprises(calendar)
    if surprises is None:
        return current
    return current.unionByName(historic_surprises(surprises)).distinct()


def earnings_mart(surprises: DataFrame) -> DataFrame:
    """Surprises for serving; the year is the one of the date."""
    return surprises.select(
        "ticker", F.year("date").alias("year"), *[c for c in SURPRISE_COLUMNS[2:] if c != "row_num"]
    )


def grades_mart(grades: DataFrame) -> DataFrame:
    return grades.select(
        "ticker",
        "date",
        "gradingCompany",
        "previousGrade",
        "newGrade",
        "action",
        classify_grade(F.col("newGrade"), F.col("action")).alias("sentiment"),
    )


def last_quarters(surprises: DataFrame, count: int = 4) -> DataFrame:
    """EPS surprise of every ticker in its latest quarters."""
    newest = W.partitionBy("ticker").orderBy(F.col("date").desc(), F.col("quarter").desc())
    return (
        surprises.withColumn("quarters_back", F.row_number().over(newest))
        .where(F.col("quarters_back") <= count)
        .select("ticker", "date", "quarter", "epsSurprisePercent", "quarters_back")
    )


def prices_after(events: DataFrame, bars: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """Date and close of the n-th bar after each event, for every offset n.

    Day 0 is the first bar on or after the event.  A bar looks ahead for the
    wanted ones before events and bars of a ticker are merged in date order;
    an event then takes what the first bar after it has seen.  So the bars are read and
    shuffled once.
    """
    by_date = W.partitionBy("ticker").orderBy("date")
    seen = [
        F.struct(F.lit(n).alias("offset"), F.lead("date", n).over(by_date).alias("price_date"), F.lead("close", n).over(by_date).alias("close"))
        for n in offsets
    ]
    keys = events.columns
    marks = events.select(
        "ticker", F.col("date").alias("_at"), F.lit(1).alias("_is_event"), F.struct(*keys).alias("_event")
    ).unionByName(
        bars.select("ticker", F.col("date").alias("_at"), F.lit(0).alias("_is_event"), F.array(*seen).alias("_ahead")),
        allowMissingColumns=True,
    )
    backwards = W.partitionBy("ticker").orderBy(F.col("_at").desc(), "_is_event").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    located = marks.withColumn("_seen", F.last("_ahead", ignorenulls=True).over(backwards)).where(F.col("_is_event") == 1)
    found = located.select("_event.*", F.inline("_seen"))
    return found.where(F.col("price_date").isNotNull()).select(*keys, "offset", "price_date", "close")


def normalised_performance(events: DataFrame, bars: DataFrame, days: int = 10) -> DataFrame:
    """Return since day 0 of each event on the following trading days."""
    prices = prices_after(events.select("ticker", "date"), bars, range(days + 1))
    by_event = W.partitionBy("ticker", "date")
    base = F.max(F.when(F.col("offset") == 0, F.col("close"))).over(by_event)
    return prices.withColumn("performance", F.col("close") / F.nullif(base, F.lit(0.0)) - 1)


def surprise_return_correlation(surprises: DataFrame, bars: DataFrame, return_days: int) -> DataFrame:
    """Correlation of EPS surprise and the return after it, per year and quarter."""
    events = surprises.select("ticker", "date", "quarter", "epsSurprisePercent")
    returns = (
        prices_after(events, bars, (0, return_days))
        .groupBy("ticker", "date", "quarter", "epsSurprisePercent")
        .agg(
            F.max(F.when(F.col("offset") == 0, F.col("close"))).alias("_from"),
            F.max(F.when(F.col("offset") == return_days, F.col("close"))).alias("_to"),
        )
        .withColumn("return_percent", (F.col("_to") / F.nullif(F.col("_from"), F.lit(0.0)) - 1) * 100)
        .where(F.col("return_percent").isNotNull())
    )
    return returns.groupBy(F.year("date").alias("year"), "quarter").agg(
        F.corr("epsSurprisePercent", "return_percent").alias("correlation"),
        F.count("*").alias("events"),
    )
