"""Data-quality checks.

Counting checks return one row, computed in a single pass with partial sums.
Rule checks return the offending rows: an empty result means the rule holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.operators.chunked import previous_row

PRICES = ("open", "close", "high", "low")


def _number_of(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def volume_checks(bars: DataFrame) -> DataFrame:
    return bars.agg(*_volume_counts())


def _volume_counts() -> list[Column]:
    volume, transactions = F.col("volume"), F.col("transactions")
    return [
        F.count("*").alias("total_records"),
        _number_of(volume == 0, "invalid_volume"),
        _number_of(transactions == 0, "invalid_transactions"),
        _number_of(volume < transactions, "volume_less_than_transactions"),
    ]


def price_checks(bars: DataFrame) -> DataFrame:
    return bars.agg(*_price_counts())


def _price_counts() -> list[Column]:
    open_, close, high, low = F.col("open"), F.col("close"), F.col("high"), F.col("low")
    not_positive = reduce(lambda a, b: a | b, [F.coalesce(F.col(p) <= 0, F.lit(False)) for p in PRICES])
    return [
        _number_of(high < low, "high_less_than_low"),
        _number_of(open_ > high, "open_above_high"),
        _number_of(open_ < low, "open_below_low"),
        _number_of(close > high, "close_above_high"),
        _number_of(close < low, "close_below_low"),
        _number_of(not_positive, "negative_prices"),
    ]


def timestamp_checks(df: DataFrame, arrival: str, chunk_size: int) -> DataFrame:
    """Missing dates, and dates before the ticker's previously arrived one.

    ``arrival`` is a unique number that grows as rows come in; a ticker is
    looked at in chunks of ``chunk_size`` numbers, so a hot one is spread.
    """
    chunk = F.floor(F.col(arrival) / chunk_size)
    linked = previous_row(df.select("ticker", "date", arrival), "ticker", [arrival], ["date"], chunk)
    return linked.agg(
        _number_of(F.col("date").isNull(), "null_timestamps"),
        _number_of(F.col("date") < F.col("prev_date"), "out_of_order_timestamps"),
    )


def ticker_completeness(bars: DataFrame, of_all_records: bool = False) -> DataFrame:
    """Number of tickers, and of those with too few bars.

    Too few means less than 90 % of the fullest ticker's bars.  With
    ``of_all_records`` the bar is 90 % of the whole table, which practically
    every ticker misses.
    """
    per_ticker = bars.groupBy("ticker").agg(F.count("*").alias("n"))
    measure = F.sum("n") if of_all_records else F.max("n")
    wanted = per_ticker.select(measure).scalar() * K.COMPLETENESS_SHARE
    return per_ticker.agg(
        F.count("*").alias("unique_tickers"), _number_of(F.col("n") < wanted, "incomplete_tickers")
    )


def outliers(bars: DataFrame, columns: Sequence[str] = ("volume", *PRICES), sigmas: float = K.OUTLIER_SIGMAS) -> DataFrame:
    """Values further than some standard deviations from the mean, per column."""
    stats = bars.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}_sd") for c in columns]
        ).alias("s")
    ).scalar()
    counts = []
    for c in columns:
        mean, reach = stats.getField(f"{c}_mean"), stats.getField(f"{c}_sd") * sigmas
        counts.append(_number_of((F.col(c) > mean + reach) | (F.col(c) < mean - reach), f"{c}_outliers"))
    return bars.agg(*counts)


def null_percentages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return df.agg(*_null_percentages(columns))


def _null_percentages(columns: Sequence[str]) -> list[Column]:
    total = F.nullif(F.count("*"), F.lit(0))
    return [(F.count_if(F.col(c).isNull()) / total * 100).alias(f"{c}_null_percentage") for c in columns]


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count and percentage of missing values, one row per column."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    long = counted.unpivot(["_total"], columns, "field", "missing")
    percent = F.coalesce(F.col("missing") / F.nullif(F.col("_total"), F.lit(0)) * 100, F.lit(0.0))
    return long.select("field", "missing", percent.alias("percentage"))


def load_gate(bars: DataFrame) -> DataFrame:
    """The checks a load must pass, one row each, from one pass over the bars."""
    nulls = ("ticker", "volume", "open", "high", "low", "close")
    facts = bars.agg(*_volume_counts(), *_price_counts(), *_null_percentages(nulls))
    no_transactions = F.col("invalid_transactions") / F.nullif(F.col("total_records"), F.lit(0)) * 100
    checks = [("Invalid transactions percentage", no_transactions < K.MAX_INVALID_TRANSACTIONS_PERCENT)]
    for name in (
        "volume_less_than_transactions", "high_less_than_low", "open_above_high", "open_below_low",
        "close_above_high", "close_below_low", "negative_prices", *[f"{c}_null_percentage" for c in nulls],
    ):
        checks.append((name.replace("_", " ").capitalize(), F.col(name) == 0))
    rows = [
        F.struct(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"))
        for name, passed in checks
    ]
    return facts.select(F.inline(F.array(*rows)))


def passes_load_gate(bars: DataFrame) -> bool:
    """Whether a load may go ahead; fourteen rows are looked at, not the bars."""
    return load_gate(bars).where(~F.col("passed")).isEmpty()


# Rules: every function returns the rows that break it.


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations of values, that occur more than once."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(known).groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside a list, with how often they occur."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def at_least(df: DataFrame, greater: str, smaller: str) -> DataFrame:
    """Rows where the first column is below the second."""
    return df.where(F.col(greater) < F.col(smaller))


def is_positive(df: DataFrame, column: str, severity: str = "error") -> DataFrame:
    return df.where(F.col(column) <= 0).withColumn("severity", F.lit(severity))


def is_even(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) % 2 == 1)


def is_odd(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) % 2 == 0)


def array_not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.size(column) == 0)


def value_length_between(df: DataFrame, column: str, shortest: int, longest: int) -> DataFrame:
    """Rows where a value has too few or too many characters."""
    return df.where(~F.length(F.col(column).cast("string")).between(shortest, longest))


def negative_totals(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Keys whose amounts do not add up to zero or more."""
    return df.groupBy(key).agg(F.sum(amount).alias("total")).where(~(F.col("total") >= 0))


def fill_calendar(bars: DataFrame, values: Sequence[str] = ("close",)) -> DataFrame:
    """One row per ticker and calendar day, gaps filled with the last values.

    Each bar is repeated up to the day before the next one, so the calendar
    needs no join and no look-back.
    """
    following = F.lead("date").over(W.partitionBy("ticker").orderBy("date"))
    until = F.coalesce(F.date_sub(following, 1), F.col("date"))
    spread = bars.select("ticker", F.col("date").alias("_traded"), *values, F.sequence("date", until).alias("_days"))
    return spread.select(
        "ticker", F.explode("_days").alias("date"), *values, "_traded"
    ).select("ticker", "date", *values, (F.col("date") != F.col("_traded")).alias("is_filled"))


def price_jumps(bars: DataFrame, threshold_percent: float) -> DataFrame:
    """Bars that open or close unusually far from the previous close."""
    by_date = W.partitionBy("ticker").orderBy("date")
    linked = bars.select("ticker", "date", "close", F.lag("close").over(by_date).alias("prev_close"))
    jump = (F.col("close") / F.nullif(F.col("prev_close"), F.lit(0.0)) - 1) * 100
    return linked.withColumn("jump_percent", jump).where(F.abs("jump_percent") > threshold_percent)
