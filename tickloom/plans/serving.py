"""The questions a dashboard asks, each one DataFrame over the stored tables.

All take one ticker, or None for all tickers at once, and an optional size
class.  Tickers are chosen before any window runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.operators import bars as B
from tickloom.operators import fundamentals, indicators, market, signals
from tickloom.operators import tickers as T
from tickloom.plans.marts import Marts
from tickloom.session import freeze

PERIODS = {"daily": "day", "weekly": "week", "monthly": "month"}
_CATEGORY = ("market_cap_category",)


def _period(aggregation: str) -> str:
    if aggregation not in PERIODS:
        raise ValueError(f"aggregation must be one of {sorted(PERIODS)}, not {aggregation!r}")
    return PERIODS[aggregation]


def _chosen(
    marts: Marts, table: DataFrame, start: str, end: str, category: str | None, ticker: str | None
) -> DataFrame:
    scored = marts.scored
    if ticker:
        table, scored = table.where(F.col("ticker") == ticker), scored.where(F.col("ticker") == ticker)
    return T.in_category(market.filter_dates(table, start, end), scored, category)


def categories(marts: Marts) -> DataFrame:
    return T.category_list(marts.scored)


def tickers(marts: Marts, category: str | None = "Mega Cap") -> DataFrame:
    return T.ticker_picker(marts.classified, category)


def candlestick(
    marts: Marts,
    period: str | None = "last_5_days",
    aggregation: str = "daily",
    category: str | None = None,
    ticker: str | None = None,
) -> DataFrame:
    latest = B.latest(marts.daily)
    return market.candlestick(
        marts.cumulated, marts.scored, latest, period, _period(aggregation), category, ticker
    ).orderBy("ticker", "time")


def moving_average(
    marts: Marts,
    kind: str,
    start: str,
    end: str,
    window: int = 20,
    aggregation: str = "daily",
    category: str | None = None,
    ticker: str | None = None,
) -> DataFrame:
    """Close, average and crossings; ``kind`` is sma, ema or wma."""
    if kind not in ("sma", "ema", "wma"):
        raise ValueError(f"unknown moving average {kind!r}")
    if window not in K.MA_WINDOWS:
        raise ValueError(f"stored windows are {K.MA_WINDOWS}")
    table = _chosen(marts, getattr(marts, kind), start, end, category, ticker)
    column, period = f"{kind}_{window}", _period(aggregation)
    if period == "day":
        found = signals.moving_average_signals(table, column, kind, carry=_CATEGORY)
    else:
        found = signals.moving_average_period_signals(table, column, kind, period, carry=_CATEGORY)
    return found.orderBy("ticker", "date")


def bollinger(
    marts: Marts,
    start: str,
    end: str,
    window: int = K.BOLLINGER_WINDOW,
    width: float = K.BOLLINGER_WIDTH,
    aggregation: str = "daily",
    category: str | None = None,
    ticker: str | None = None,
) -> DataFrame:
    table = _chosen(marts, marts.sma, start, end, category, ticker)
    bands = indicators.bollinger(table, window, width, carry=_CATEGORY)
    return signals.bollinger_signals(bands, _period(aggregation), carry=_CATEGORY).orderBy("ticker", "date")


def macd(
    marts: Marts,
    start: str,
    end: str,
    aggregation: str = "daily",
    category: str | None = "Mega Cap",
    ticker: str | None = None,
) -> DataFrame:
    table = _chosen(marts, marts.macd, start, end, category, ticker)
    return signals.macd_signals(table, _period(aggregation), carry=_CATEGORY).orderBy("ticker", "date")


def _events(
    marts: Marts, category: str | None, ticker: str | None, quarter: int | None = None, year: int | None = None
) -> DataFrame:
    """Earnings of reliable tickers, of a class, ticker, quarter or year if named, with the class."""
    events = marts.earnings
    for column, value in (("ticker", ticker), ("quarter", quarter)):
        if value is not None:
            events = events.where(F.col(column) == value)
    if year is not None:
        events = events.where(F.year("date") == year)
    return T.in_category(events, marts.scored, category)


def eps_surprises(
    marts: Marts, category: str | None = None, ticker: str | None = None, quarters: int = 4
) -> DataFrame:
    """EPS surprise in percent over each ticker's latest quarters."""
    latest = fundamentals.last_quarters(_events(marts, category, ticker), quarters)
    return latest.orderBy("ticker", "quarters_back")


def eps_performance(
    marts: Marts,
    category: str | None = None,
    ticker: str | None = None,
    quarter: int | None = None,
    year: int | None = None,
    days: int = 10,
) -> DataFrame:
    """Return since each announcement on the trading days after it."""
    events = _events(marts, category, ticker, quarter, year)
    found = fundamentals.normalised_performance(events, _bars_of(marts, ticker), days)
    return found.orderBy("ticker", "date", "offset")


def eps_correlation(
    marts: Marts,
    category: str | None = None,
    ticker: str | None = None,
    quarter: int | None = None,
    year: int | None = None,
    return_days: int = 5,
) -> DataFrame:
    """Correlation of EPS surprise and the return over some days after it."""
    events = _events(marts, category, ticker, quarter, year)
    return fundamentals.surprise_return_correlation(events, _bars_of(marts, ticker), return_days).orderBy("year", "quarter")


def _bars_of(marts: Marts, ticker: str | None) -> DataFrame:
    return marts.daily if ticker is None else marts.daily.where(F.col("ticker") == ticker)


def market_sentiment(marts: Marts, as_of: Column) -> DataFrame:
    changes = B.month_end_changes(marts.cumulated)
    return market.market_sentiment(changes, T.leading_tickers(marts.scored), as_of)


def market_dashboard(marts: Marts, as_of: Column, symbols: Sequence[str] = K.WATCHLIST) -> DataFrame:
    """The whole overview as one row of nested values.

    Every part is a scalar subquery with one row; the watchlist is an array of
    as many entries as symbols were asked for.  What is missing reads N/A or 0.
    Month ends, which most parts look at, are derived once and stored, the only thing that runs here.
    """
    changes = freeze(B.month_end_changes(marts.cumulated))
    leaders = T.leading_tickers(marts.scored)
    movers = market.newest_movers(changes)

    def one(df: DataFrame) -> Column:
        return df.select(F.struct("*")).scalar()

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit("N/A"))

    def number(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    mood = one(market.market_sentiment(changes, leaders, as_of))
    leader = one(market.market_leader(changes, leaders, marts.with_news, as_of))
    sectors = one(market.best_and_worst_sector(market.sector_performance(changes, marts.enriched, as_of)))
    stocks = one(market.best_and_worst_stock(movers))
    entry = F.struct(
        "ticker",
        text(F.col("name")).alias("company_name"),
        text(F.col("branding_icon_url")).alias("branding_icon"),
        text(F.col("branding_logo_url")).alias("branding_logo"),
        number(F.col("price")).alias("price"),
        number(F.col("change_pct")).alias("change_pct"),
        "direction",
    )
    summary = (
        market.watchlist(movers, marts.enriched, symbols).agg(F.array_sort(F.collect_list(entry)).alias("a")).scalar()
    )

    def sector(end: str) -> Column:
        return F.struct(
            text(sectors[f"{end}_sector"]).alias("name"), number(sectors[f"{end}_sector_change"]).alias("change_pct")
        ).alias(f"{end}_sector")

    def stock(end: str) -> Column:
        return F.struct(
            text(stocks[f"{end}_stock_ticker"]).alias("ticker"),
            number(stocks[f"{end}_stock_price"]).alias("price"),
            number(stocks[f"{end}_stock_change"]).alias("change_pct"),
        ).alias(f"{end}_stock")

    return marts.daily.sparkSession.range(1).select(
        mood["market_sentiment"].alias("market_sentiment"),
        F.struct(
            text(leader["ticker"]).alias("ticker"),
            number(leader["close"]).alias("price"),
            number(leader["pct_change"]).alias("change_pct"),
            text(leader["current_sentiment"]).alias("current_sentiment"),
            text(leader["branding_logo_url"]).alias("branding_logo"),
            text(leader["branding_icon_url"]).alias("branding_icon"),
        ).alias("leader"),
        sector("hottest"),
        sector("worst"),
        stock("top"),
        stock("worst"),
        summary.alias("market_summary"),
    )


def stock_trend(
    marts: Marts, as_of: Column, ticker: str | None = K.DEFAULT_TICKER, days: int | str = K.DEFAULT_TREND_DAYS
) -> tuple[DataFrame, DataFrame]:
    """What is known about a ticker, and its recent bars."""
    return market.stock_info(marts.classified, ticker), market.stock_trend(marts.daily, as_of, ticker, days)
