from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

START = dt.date(2024, 1, 1)
BAR_SCHEMA = (
    "ticker string, date date, open double, high double, low double, close double, volume double, transactions bigint"
)


def day(n: int) -> dt.date:
    return START + dt.timedelta(days=n)


def bars(spark: SparkSession, closes: dict[str, Sequence[float]], dates: Sequence[dt.date] | None = None) -> DataFrame:
    """Bars on consecutive days from lists of closes."""
    rows = [
        (t, (dates or [day(i) for i in range(len(values))])[i], c, c + 1, c - 1, c, 100.0 * (i + 1), i + 1)
        for t, values in closes.items()
        for i, c in enumerate(values)
    ]
    return spark.createDataFrame(rows, BAR_SCHEMA)


def rows(df: DataFrame, *order: str) -> list[tuple]:
    """All rows as tuples, ordered."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def column(df: DataFrame, name: str, *order: str) -> list:
    return [r[name] for r in df.orderBy(*order).collect()]


def executed_plan(df: DataFrame) -> str:
    """The physical plan as it ran, with all adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
