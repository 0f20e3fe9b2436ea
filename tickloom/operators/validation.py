"""Comparison of calculated indicators with those of a vendor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.functions.columns import date_from_millis, percent_error


def consolidate_vendor(points: DataFrame, prefix: str, windows: Sequence[int] = K.MA_WINDOWS) -> DataFrame:
    """Vendor values, one row per window, into one row per ticker and day.

    Input: ticker, window, timestamp in milliseconds, value.  Of several
    values for a day the latest one counts.
    """
    dated = points.where(F.coalesce(F.col("timestamp"), F.lit(0)) != 0).select(
        "ticker", "window", "timestamp", "value", date_from_millis(F.col("timestamp")).alias("date")
    )
    newest = {
        n: F.max_by("value", F.when(F.col("window") == n, F.col("timestamp"))).alias(f"{prefix}_{n}") for n in windows
    }
    return dated.groupBy("ticker", F.col("date").alias("timestamp")).agg(*newest.values())


def indicator_errors(
    vendor: DataFrame,
    calculated: DataFrame,
    prefix: str,
    windows: Sequence[int] = K.MA_WINDOWS,
    threshold: float = K.DAILY_ERROR_THRESHOLD,
) -> DataFrame:
    """Error of every window against the vendor; one join serves all windows.

    An error that cannot be computed is not critical.
    """
    ours = calculated.select(
        "ticker", F.col("date").alias("timestamp"), *[F.col(f"{prefix}_{n}").alias(f"_{n}") for n in windows]
    )
    columns = []
    for n in windows:
        theirs, mine = F.col(f"{prefix}_{n}"), F.col(f"_{n}")
        error = percent_error(theirs, mine)
        columns += [
            theirs.alias(f"{prefix}_{n}_vendor"),
            mine.alias(f"{prefix}_{n}_calculated"),
            error.alias(f"{prefix}_{n}_error_percent"),
            F.coalesce(error > threshold, F.lit(False)).alias(f"{prefix}_{n}_is_critical"),
        ]
    return vendor.join(ours, ["ticker", "timestamp"], "left").select("ticker", "timestamp", *columns)


def critical_counts(errors: DataFrame, prefix: str, windows: Sequence[int] = K.MA_WINDOWS, by_day: bool = False) -> DataFrame:
    """Number of critical errors per ticker (and day) and window, where any."""
    keys = ["ticker", "timestamp"] if by_day else ["ticker"]
    wide = errors.groupBy(*keys).agg(*[F.count_if(F.col(f"{prefix}_{n}_is_critical")).alias(str(n)) for n in windows])
    long = wide.unpivot(keys, [str(n) for n in windows], "window", "critical")
    return long.where(F.col("critical") > 0).withColumn("window", F.col("window").cast("int"))


def critical_yesterday(errors: DataFrame, prefix: str, windows: Sequence[int] = K.MA_WINDOWS) -> DataFrame:
    """Critical rows of the day before the newest one."""
    flags = [f"{prefix}_{n}_is_critical" for n in windows]
    day = F.date_sub(errors.select(F.max("timestamp")).scalar(), 1)
    return errors.where((F.col("timestamp") == day) & F.greatest(*flags)).select("ticker", "timestamp", *flags)
