"""Scans: bulk files, seeds and slices of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.columns import date_from_nanos


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bulk daily bars from CSV files; ``path`` may be a glob over dated folders.

    The schema is declared, so no file is read twice to guess it.
    """
    raw = spark.read.schema(schemas.BULK_BAR_FILE).option("header", True).csv(path)
    return raw.select(
        "ticker",
        "volume",
        "open",
        "high",
        "low",
        "close",
        "transactions",
        date_from_nanos(F.col("window_start")).alias("date"),
    )


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A small lookup file with code and name."""
    return spark.read.schema(schemas.SEED).option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def slice_condition(ticker: str | None, start_date: str | None, end_date: str | None) -> Column:
    condition = F.lit(True)
    if ticker:
        condition = condition & (F.col("ticker") == ticker)
    if start_date:
        condition = condition & (F.col("date") >= F.to_date(F.lit(start_date)))
    if end_date:
        condition = condition & (F.col("date") <= F.to_date(F.lit(end_date)))
    return condition


def read_slice(
    table: DataFrame, ticker: str | None = None, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Rows of a ticker and a date range, both ends included; each part optional.

    The conditions reach the file scan, and prune folders where the table is
    partitioned by date.
    """
    return table.where(slice_condition(ticker, start_date, end_date))


def read_jdbc_slice(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    first_date: str,
    last_date: str,
    partitions: int,
    ticker: str | None = None,
) -> DataFrame:
    """The same slice from a database, read in parallel ranges of dates."""
    options = {
        "url": url,
        "dbtable": table,
        "partitionColumn": "date",
        "lowerBound": first_date,
        "upperBound": last_date,
        "numPartitions": str(partitions),
        **properties,
    }
    return read_slice(spark.read.format("jdbc").options(**options).load(), ticker, first_date, last_date)
