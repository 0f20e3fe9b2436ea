"""Operators on daily bars: split adjustment, monthly arrays, candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.columns import percent_change, period_start

BAR_FIELDS = ("date", "open", "high", "low", "close", "volume", "transactions")


def latest(df: DataFrame, column: str = "date") -> Column:
    """Greatest value of a column, as a scalar subquery of the surrounding plan."""
    return df.select(F.max(column)).scalar()


def split_factors(splits: DataFrame) -> DataFrame:
    """One row per ticker: its split ratios, ordered by date.

    Ratios of one day are multiplied first, so the array of a ticker has at
    most one entry per calendar day however many rows the table holds.
    """
    per_day = splits.groupBy("ticker", "date").agg(
        F.product(F.col("split_to") / F.col("split_from")).alias("ratio")
    )
    return per_day.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("date", "ratio"))).alias("splits"))


def adjust_for_splits(bars: DataFrame, splits: DataFrame, apply: bool = True) -> DataFrame:
    """Restate bars in today's shares: every split strictly after the bar counts.

    The range condition is evaluated inside the array of a ticker's splits, so
    the join is a plain equality on the ticker and no bar is multiplied.
    """
    if not apply:
        return bars
    joined = bars.join(split_factors(splits), "ticker", "left")
    later = F.filter("splits", lambda s: s["date"] > F.col("date"))
    factor = F.coalesce(F.aggregate(later, F.lit(1.0), lambda acc, s: acc * s["ratio"]), F.lit(1.0))
    return (
        joined.withColumn("factor", factor)
        .withColumns(
            {
                "volume": F.col("volume") * F.col("factor"),
                **{c: F.col(c) / F.col("factor") for c in ("open", "high", "low", "close")},
            }
        )
        .select(*bars.columns)
    )


def cumulate_months(bars: DataFrame) -> DataFrame:
    """One row per ticker and month, its bars in one date-ordered array.

    ``collect_set`` drops exact copies already in the map tasks; what is left
    of a group are the bars of one month.
    """
    return (
        bars.groupBy("ticker", F.year("date").alias("year"), F.month("date").alias("month_num"))
        .agg(
            F.array_sort(F.collect_set(F.struct(*BAR_FIELDS))).alias("bars"),
            F.count("*").alias("record_count"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        .withColumn("processed_at", F.current_timestamp())
    )


def merge_months(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Stored months with arriving bars in them: as ``cumulate_months`` of all bars would have them.

    Arrays are united by bar, so late bars take their place by date, corrected ones stand beside what they correct, and
    copies are dropped; counts are of rows, copies included.  Months that no bar arrives for stay as they are.  Either side
    travels once.
    """
    month = ["ticker", "year", "month_num"]
    facts = ("bars", "record_count", "first_date", "last_date", "processed_at")
    new = cumulate_months(arrived)
    before = stored.select(*month, F.struct(*facts).alias("before"))
    both = new.join(before, month, "full")
    united = F.array_sort(F.array_union("bars", F.col("before.bars")))
    return both.select(
        *month,
        F.when(F.col("before").isNull(), F.col("bars")).when(F.col("record_count").isNull(), F.col("before.bars")).otherwise(united).alias("bars"),
        (F.coalesce("record_count", F.lit(0)) + F.coalesce("before.record_count", F.lit(0))).alias("record_count"),
        F.least("first_date", "before.first_date").alias("first_date"),
        F.greatest("last_date", "before.last_date").alias("last_date"),
        F.coalesce("processed_at", "before.processed_at").alias("processed_at"),
    )


def unpack_bars(cumulated: DataFrame, *keep: str) -> DataFrame:
    """Back to one row per bar; only the array fields in use are read."""
    return cumulated.select("ticker", *keep, F.inline("bars"))


def flag_periods(cumulated: DataFrame) -> DataFrame:
    """Mark the months of the current year, and the current month.

    The current month is the greatest month number of the whole table in the
    greatest year, which no row may have while the year is still young.
    """
    this_year = F.col("year") == latest(cumulated, "year")
    this_month = F.col("month_num") == latest(cumulated, "month_num")
    return cumulated.select(
        "ticker",
        "year",
        "month_num",
        "bars",
        (this_year & this_month).alias("is_current_month"),
        this_year.alias("is_current_year"),
    )


def candles(bars: DataFrame, period: str = "day") -> DataFrame:
    """Open, high, low, close and volume per day, week or month.

    First and last are taken by date, so the aggregate is combined in the map
    tasks and needs no window.
    """
    if period == "day":
        return bars.select("ticker", F.col("date").alias("time"), "open", "high", "low", "close", "volume")
    return bars.groupBy("ticker", period_start(F.col("date"), period).alias("time")).agg(
        F.min_by("open", "date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"),
        F.sum("volume").alias("volume"),
    )


def month_end_changes(cumulated: DataFrame) -> DataFrame:
    """Last and previous close of every ticker and month.

    The previous close is the last but one of the month, else the last of the
    preceding month on file.  Only the two closes travel through the shuffle,
    not the arrays.
    """
    closes = cumulated.select(
        "ticker",
        "year",
        "month_num",
        "last_date",
        F.try_element_at("bars", F.lit(-1))["close"].alias("close"),
        F.try_element_at("bars", F.lit(-2))["close"].alias("close_before"),
    )
    by_month = W.partitionBy("ticker").orderBy("year", "month_num")
    prev = F.coalesce("close_before", F.lag("close").over(by_month))
    return closes.withColumn("prev_close", prev).drop("close_before")


def latest_changes(month_changes: DataFrame) -> DataFrame:
    """Newest row of each ticker with its percent change."""
    newest = month_changes.groupBy("ticker").agg(
        F.max(F.struct("year", "month_num", "last_date", "close", "prev_close")).alias("row")
    )
    return newest.select("ticker", "row.*").withColumn(
        "pct_change", percent_change(F.col("close"), F.col("prev_close"))
    )
