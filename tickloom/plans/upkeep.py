"""Stored tables kept up to date by what a load changes, without a rebuild.

Each function reads the load and the partitions it touches, and leaves the table as a rebuild over
all loads would.  The partitions of a load are a few days', months' or tickers', so their values stand in the plan as
literals and other files are not listed for the scan.  New content is written beside the
partitions and takes their place when it is whole (dynamic overwrite), so it may be derived from them, is
written once, and a job that is lost before can be run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.session import Scratch
from tickloom.sources.writers import path_exists

#: Folders that the tickers of an adjusted table are dealt to.
BUCKETS = 256


def _among(columns: list[str], values: list[tuple]) -> Column:
    """Rows whose columns have one of these combinations of values."""
    found = F.lit(False)
    for value in values:
        one = F.lit(True)
        for column, v in zip(columns, value, strict=True):
            one = one & F.col(column).eqNullSafe(F.lit(v))
        found = found | one
    return found


def _replace(df: DataFrame, path: str, columns: list[str]) -> None:
    hinted = df.hint("rebalance", *[F.col(c) for c in columns])
    hinted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


# --- months ---------------------------------------------------------------------------------------

_MONTH = ["year", "month_num"]


def touched_months(stored: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    return stored.where(_among(_MONTH, months))


def update_months(spark: SparkSession, path: str, arrived: DataFrame) -> None:
    """Take arriving bars into a table of monthly arrays, partitioned by year and month.

    Not to be run twice for one load, as copies are counted; the load's rows are evaluated once.
    """
    if not path_exists(spark, path):
        _replace(B.cumulate_months(arrived), path, _MONTH)
        return
    with Scratch(spark) as scratch:
        load = scratch.keep(arrived, "arrived")
        months = [tuple(r) for r in load.select(F.year("date"), F.month("date")).distinct().collect()]
        if not months:
            return
        schema = B.cumulate_months(load).schema
        stored = touched_months(spark.read.schema(schema).parquet(path), months)
        _replace(B.merge_months(stored, load).select(*stored.columns), path, _MONTH)


# --- split adjustment -----------------------------------------------------------------------------


def bucket(ticker: str = "ticker") -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(BUCKETS)).cast("int").alias("bucket")


def store_bars(bars: DataFrame, path: str) -> None:
    """Unadjusted bars in folders by bucket of the ticker, from which any ticker can be adjusted anew."""
    _replace(bars.withColumn("bucket", bucket()), path, ["bucket"])


def touched_bars(stored: DataFrame, buckets: list[int]) -> DataFrame:
    return stored.where(F.col("bucket").isin(buckets)) if buckets else stored.where(F.lit(False))


def refresh_adjusted(spark: SparkSession, raw: str, adjusted: str, splits: DataFrame, changed: DataFrame | None = None) -> None:
    """Bring the adjusted bars up to ``splits``; ``changed`` has a ``ticker`` for each split that was added, moved or withdrawn.

    Bars of changed tickers are adjusted anew from the unadjusted ones, so they come out as a rebuild has them, to the last
    digit; their buckets alone are read and written.  Without ``changed`` all bars are.
    """
    bars = spark.read.parquet(raw)
    with Scratch(spark) as scratch:
        if changed is not None:
            tickers = scratch.keep(changed.select("ticker").distinct(), "tickers")
            buckets = [r[0] for r in tickers.select(bucket()).distinct().collect()]
            if not buckets:
                return
            bars = touched_bars(bars, buckets)
            stored = touched_bars(spark.read.schema(bars.schema).parquet(adjusted), buckets)
            anew = B.adjust_for_splits(bars.join(tickers, "ticker", "left_semi"), splits)
            fresh = stored.join(tickers, "ticker", "left_anti").unionByName(anew)
        else:
            fresh = B.adjust_for_splits(bars, splits)
        _replace(fresh, adjusted, ["bucket"])
