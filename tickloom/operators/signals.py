"""Buy and sell signals from crossing series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.columns import money, period_start
from tickloom.operators.indicators import by_date

def _with_signal(df: DataFrame, buy: Column, sell: Column, price: Column) -> DataFrame:
    return df.withColumns(
        {
            "signal": F.when(buy, "BUY").when(sell, "SELL"),
            "buy_signal": F.when(buy, price),
            "sell_signal": F.when(sell, price),
        }
    )


def cross_signal(
    df: DataFrame,
    fast: str,
    slow: str,
    price: Column | None = None,
    over: WindowSpec | None = None,
    tolerance: float = 0.0,
) -> DataFrame:
    """BUY where ``fast`` rises above ``slow``, SELL where it falls below.

    The previous row is looked up in what is passed in, so the first row of a
    filtered range never signals.  ``tolerance`` is the relative difference up
    to which the two count as equal.
    """
    over = over or by_date()

    def gap(x: Column, y: Column) -> Column:
        return x - y if not tolerance else F.when(F.abs(x - y) <= F.abs(y) * tolerance, 0.0).otherwise(x - y)

    now = gap(F.col(fast), F.col(slow))
    prepared = df.withColumns({"_pf": F.lag(fast).over(over), "_ps": F.lag(slow).over(over)})
    before = gap(F.col("_pf"), F.col("_ps"))
    buy = (now > 0) & (before <= 0)
    sell = (now < 0) & (before >= 0)
    return _with_signal(prepared, buy, sell, F.col("close") if price is None else price).drop("_pf", "_ps")


def band_signal(df: DataFrame) -> DataFrame:
    """BUY where the close drops out of the lower band, SELL out of the upper."""
    prepared = df.withColumns(
        {
            "_pc": F.lag("close").over(by_date()),
            "_pl": F.lag("lower_band").over(by_date()),
            "_pu": F.lag("upper_band").over(by_date()),
        }
    )
    buy = (F.col("close") < F.col("lower_band")) & (F.col("_pc") >= F.col("_pl"))
    sell = (F.col("close") > F.col("upper_band")) & (F.col("_pc") <= F.col("_pu"))
    return _with_signal(prepared, buy, sell, money(F.col("close"))).drop("_pc", "_pl", "_pu")


def moving_average_signals(averages: DataFrame, column: str, output: str, carry: Sequence[str] = ()) -> DataFrame:
    """Daily crossings of the close and one moving average.

    ``carry`` names facts of the ticker to keep, here and below.
    """
    daily = averages.select("ticker", "date", "close", F.col(column).alias(output), *carry)
    return cross_signal(daily, "close", output)


def moving_average_period_signals(
    averages: DataFrame,
    column: str,
    output: str,
    period: str,
    week_number_order: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Weekly or monthly crossings of the last close and the last average.

    Periods are split at the turn of the year.  They follow each other by
    their last date; ``week_number_order`` orders by year and ISO week number
    instead, which puts the last days of December (week 1) before January.
    """
    number = F.weekofyear("date") if period == "week" else F.month("date")
    ends = averages.groupBy(
        "ticker", *carry, period_start(F.col("date"), period).alias("period"), F.year("date").alias("year")
    ).agg(
        F.max("date").alias("last_date"),
        F.max_by("close", "date").alias("close"),
        F.max_by(column, "date").alias(output),
        F.max_by(number, "date").alias("period_number"),
    )
    order = ("year", "period_number", "last_date") if week_number_order else ("year", "last_date")
    signalled = cross_signal(ends, "close", output, over=W.partitionBy("ticker").orderBy(*order))
    return signalled.select(
        "ticker",
        F.col("period").alias("date"),
        "year",
        "close",
        output,
        "signal",
        "buy_signal",
        "sell_signal",
        *carry,
    )


def last_of_period(df: DataFrame, columns: list[str], period: str, carry: Sequence[str] = ()) -> DataFrame:
    """The values of the last row of every ticker and period, dated by the period."""
    return df.groupBy("ticker", *carry, period_start(F.col("date"), period).alias("period")).agg(
        *[F.max_by(c, "date").alias(c) for c in columns]
    ).withColumnRenamed("period", "date")


def bollinger_signals(bands: DataFrame, period: str = "day", carry: Sequence[str] = ()) -> DataFrame:
    """Band break-outs per day, week or month; amounts in cents precision.

    Bands are computed on daily rows and then reduced to the last row of a
    period, so the deviation always spans days.
    """
    if period != "day":
        bands = last_of_period(bands, ["close", "middle_band", "upper_band", "lower_band"], period, carry)
    amounts = {c: money(F.col(c)) for c in ("close", "middle_band", "upper_band", "lower_band")}
    return band_signal(bands).withColumns(amounts)


def macd_signals(macd: DataFrame, period: str = "day", carry: Sequence[str] = ()) -> DataFrame:
    """Crossings of MACD and signal line, histogram split by sign.

    The sign is read from the histogram in cents, the value is passed on in
    full.  Daily rows know their predecessor from before any date filter;
    periods compare with the previous period in range.
    """
    if period != "day":
        macd = last_of_period(macd, ["close", "macd_line", "signal_line", "macd_histogram"], period, carry)
        macd = macd.withColumns(
            {
                "prev_macd_line": F.lag("macd_line").over(by_date()),
                "prev_signal_line": F.lag("signal_line").over(by_date()),
            }
        )
    line, signal = F.col("macd_line"), F.col("signal_line")
    buy = (line > signal) & (F.col("prev_macd_line") <= F.col("prev_signal_line"))
    sell = (line < signal) & (F.col("prev_macd_line") >= F.col("prev_signal_line"))
    cents = money(F.col("macd_histogram"))
    return _with_signal(macd, buy, sell, money(F.col("close"))).select(
        "ticker",
        "date",
        money(F.col("close")).alias("close"),
        money(line).alias("macd_line"),
        money(signal).alias("signal_line"),
        F.when(cents >= 0, F.col("macd_histogram")).alias("positive_histogram"),
        F.when(cents < 0, F.col("macd_histogram")).alias("negative_histogram"),
        "signal",
        "buy_signal",
        "sell_signal",
        *carry,
    )
