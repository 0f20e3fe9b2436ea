"""Scalar building blocks shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom import constants as K


def nonzero(value: Column) -> Column:
    """NULL instead of zero, so that a division yields NULL and never raises."""
    return F.nullif(value, F.lit(0))


def percent_change(new: Column, old: Column) -> Column:
    return (new - old) / nonzero(old) * 100


def percent_error(measured: Column, expected: Column) -> Column:
    return F.abs((measured - expected) / nonzero(expected)) * 100


def market_cap_category(market_cap: Column) -> Column:
    """Name of the size class; an unknown cap counts as the smallest class."""
    chain = reduce(
        lambda when, rule: when.when(market_cap >= rule[1], rule[0]),
        K.CAP_CATEGORIES[1:],
        F.when(market_cap >= K.CAP_CATEGORIES[0][1], K.CAP_CATEGORIES[0][0]),
    )
    return chain.otherwise(K.SMALLEST_CAP_CATEGORY)


def market_cap_order(category: Column) -> Column:
    """Position of a size class, largest first."""
    names = [name for name, _ in K.CAP_CATEGORIES] + [K.SMALLEST_CAP_CATEGORY]
    return F.array_position(F.array(*[F.lit(name) for name in names]), category)


def liquidity_score(traded_value: Column) -> Column:
    chain = reduce(
        lambda when, rule: when.when(traded_value >= rule[1], rule[0]),
        K.LIQUIDITY_SCORES[1:],
        F.when(traded_value >= K.LIQUIDITY_SCORES[0][1], K.LIQUIDITY_SCORES[0][0]),
    )
    return chain.otherwise(K.LOWEST_LIQUIDITY_SCORE)


def _mentions(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("|".join(words))


def classify_grade(grade: Column, action: Column) -> Column:
    """BUY, HOLD or SELL by the words of an analyst's grade; the first match wins.

    The order matters: "Underperform" contains "perform" and is a HOLD,
    "Strong Sell" contains "strong" and is a BUY.
    """
    buy = F.coalesce(_mentions(grade, K.BUY_GRADE_WORDS), F.lit(False)) | F.lower(action).contains(K.BUY_ACTION_WORD)
    sell = F.coalesce(_mentions(grade, K.SELL_GRADE_WORDS), F.lit(False)) | F.lower(action).contains(
        K.SELL_ACTION_WORD
    )
    return F.when(buy, "BUY").when(_mentions(grade, K.HOLD_GRADE_WORDS), "HOLD").when(sell, "SELL")


def cents_to_dollars(cents: Column) -> Column:
    return (cents / 100).cast("decimal(16,2)")


def money(value: Column) -> Column:
    return value.cast("decimal(20,2)")


def period_start(date: Column, period: str) -> Column:
    """First day of the week (Monday) or month a date lies in."""
    if period not in ("week", "month"):
        raise ValueError(f"period must be 'week' or 'month', not {period!r}")
    return F.to_date(F.date_trunc(period, date))


def _epoch_day(count: Column, per_day: int) -> Column:
    """Whole days since the epoch, in integer arithmetic up to the last division."""
    return F.date_from_unix_date(((count - F.pmod(count, F.lit(per_day))) / per_day).cast("int"))


def date_from_millis(millis: Column) -> Column:
    """UTC date of an epoch in milliseconds; zero means missing."""
    return _epoch_day(nonzero(millis), 86_400_000)


def date_from_nanos(nanos: Column) -> Column:
    """UTC date of an epoch in nanoseconds."""
    return _epoch_day(nanos, 86_400_000_000_000)


def within_period(date: Column, latest: Column, period: str | None) -> Column:
    """Whether a date lies in a named period that ends at ``latest``.

    An unknown name means no restriction.
    """
    months_back = {"last_3_months": 3, "last_6_months": 6, "last_1_year": 12, "last_4_years": 48}
    if period == "last_5_days":
        return date >= F.date_sub(latest, 5)
    if period in months_back:
        return date >= F.add_months(latest, -months_back[period])
    if period == "mtd":
        return F.trunc(date, "month") == F.trunc(latest, "month")
    if period == "ytd":
        return F.trunc(date, "year") == F.trunc(latest, "year")
    return F.lit(True)
