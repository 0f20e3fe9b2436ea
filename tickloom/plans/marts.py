"""The tables of the platform, each a lazy DataFrame over the ones below it.

Asking for a table composes one plan down to the sources and runs nothing,
but for ``classified``: its ranks need the scores and the borders of their
ranges fixed, so these are stored when it is asked for.  ``save`` stores a table and lets everything built
afterwards read the stored copy, which is how a daily run works through the
layers.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from tickloom.operators import bars as B
from tickloom.operators import fundamentals, indicators, staging
from tickloom.operators import tickers as T
from tickloom.sources.writers import write_clustered

# Tables in the order a daily run stores them, with the columns they are
# clustered by.
STORED = {
    "bars": ("ticker", "date"),
    "daily": ("ticker", "date"),
    "cumulated": ("ticker", "year", "month_num"),
    "earnings": ("ticker", "date"),
    "candlesticks": ("ticker", "year", "month_num"),
    "classified": ("ticker",),
    "with_news": ("ticker",),
    "macd": ("ticker", "date"),
    "earnings_mart": ("ticker", "date"),
    "grades": ("ticker", "date"),
    "sma": ("ticker", "date"),
    "wma": ("ticker", "date"),
    "ema": ("ticker", "date"),
}


# What the moving-average tables know about the month of a bar.
_MONTH_FACTS = ("year", "month_num", "is_current_month", "is_current_year")


class Marts:
    """Tables over a mapping of raw sources.

    Sources: bars, tickers, ticker_details, sic_codes, splits, news,
    earnings_calendar, earnings_surprises, grades, exchanges.
    """

    def __init__(self, sources: Mapping[str, DataFrame], apply_split_adjustment: bool = False) -> None:
        self.sources = sources
        self.apply_split_adjustment = apply_split_adjustment
        self._stored_at: set[str] = set()

    @cached_property
    def tickers(self) -> DataFrame:
        return staging.stage_tickers(self.sources["tickers"])

    @cached_property
    def ticker_details(self) -> DataFrame:
        return staging.stage_ticker_details(self.sources["ticker_details"])

    @cached_property
    def bars(self) -> DataFrame:
        return staging.stage_bars(self.sources["bars"], self.tickers)

    @cached_property
    def splits(self) -> DataFrame:
        return staging.stage_splits(self.sources["splits"])

    @cached_property
    def news(self) -> DataFrame:
        return staging.stage_news(self.sources["news"])

    @cached_property
    def calendar(self) -> DataFrame:
        return staging.stage_earnings_calendar(self.sources["earnings_calendar"])

    @cached_property
    def surprise_history(self) -> DataFrame:
        return staging.stage_earnings_surprises(self.sources["earnings_surprises"])

    @cached_property
    def daily(self) -> DataFrame:
        return B.adjust_for_splits(self.bars, self.splits, self.apply_split_adjustment)

    @cached_property
    def cumulated(self) -> DataFrame:
        return B.cumulate_months(self.daily)

    @cached_property
    def candlesticks(self) -> DataFrame:
        return B.flag_periods(self.cumulated)

    @cached_property
    def enriched(self) -> DataFrame:
        sic_codes = staging.stage_sic_codes(self.sources["sic_codes"])
        return T.enrich_tickers(self.tickers, self.ticker_details, sic_codes)

    @cached_property
    def scored(self) -> DataFrame:
        return T.score_tickers(T.liquidity(self.daily, B.latest(self.daily)), self.enriched)

    @cached_property
    def classified(self) -> DataFrame:
        return T.classify_tickers(self.scored)

    @cached_property
    def with_news(self) -> DataFrame:
        return T.tickers_with_news(self.enriched, self.news)

    @cached_property
    def earnings(self) -> DataFrame:
        history = self.surprise_history if self.apply_split_adjustment else None
        return fundamentals.earnings_surprises(self.calendar, history)

    @cached_property
    def earnings_mart(self) -> DataFrame:
        return fundamentals.earnings_mart(self.earnings)

    @cached_property
    def grades(self) -> DataFrame:
        return fundamentals.grades_mart(staging.stage_grades(self.sources["grades"]))

    @cached_property
    def _flagged_closes(self) -> DataFrame:
        return B.unpack_bars(self.candlesticks, *_MONTH_FACTS)

    @cached_property
    def sma(self) -> DataFrame:
        return indicators.sma(self._flagged_closes, carry=_MONTH_FACTS)

    @cached_property
    def wma(self) -> DataFrame:
        return indicators.wma(self._flagged_closes, carry=_MONTH_FACTS)

    @cached_property
    def ema(self) -> DataFrame:
        return indicators.ema(self._flagged_closes, carry=_MONTH_FACTS)

    @cached_property
    def macd(self) -> DataFrame:
        return indicators.macd(self.daily)

    def save(self, name: str, root: str, mode: str = "overwrite") -> DataFrame:
        """Store one table under ``root`` and read it from there from now on.

        A table that is read from there already cannot be stored there again.
        """
        path = f"{root.rstrip('/')}/{name}"
        if path in self._stored_at:
            raise ValueError(f"{name} is read from {path}; build it anew with other Marts, or store it elsewhere")
        table: DataFrame = getattr(self, name)
        write_clustered(table, path, mode, STORED[name])
        self._stored_at.add(path)
        stored = table.sparkSession.read.schema(table.schema).parquet(path)
        self.__dict__[name] = stored
        return stored

    def save_all(self, root: str) -> None:
        for name in STORED:
            self.save(name, root)
