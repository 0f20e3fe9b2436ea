"""Moving averages, MACD and Bollinger bands over daily closes.

Every window is partitioned by ticker and ordered by date: Spark shuffles once
and the rest of the chain reuses that layout.  Bars are unique per ticker and
day, so the largest group is bounded by the number of trading days, however
large a share of all rows one ticker holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.operators.recurrence import Smoothing, block_size, by_block, exponential_averages, in_blocks, next_state, numbered

def by_date() -> WindowSpec:
    return W.partitionBy("ticker").orderBy("date")


def trailing_sums(df: DataFrame, values: dict[str, Column], windows: Sequence[int], over: WindowSpec) -> DataFrame:
    """Add ``{name}_{n}`` = sum of the last n rows, for several n at once.

    A sliding frame costs n additions per row.  Longer sums are put together
    from shorter ones instead: the last 20 rows are the last 10 plus what the
    last 10 were ten rows ago.  Rows missing at the start count as nothing.
    """
    done: list[int] = []
    for n in sorted(set(windows)):
        offset, parts = 0, []
        for m in reversed(done):
            while n - offset >= m:
                parts.append((m, offset))
                offset += m
        if offset == n and parts:
            columns = {f"{name}_{n}": _chain(name, parts, over) for name in values}
        else:
            frame = over.rowsBetween(1 - n, 0)
            columns = {f"{name}_{n}": F.sum(value).over(frame) for name, value in values.items()}
        df = df.withColumns(columns)
        done.append(n)
    return df


def _chain(name: str, parts: list[tuple[int, int]], over: WindowSpec) -> Column:
    total = None
    for size, offset in parts:
        part = F.col(f"{name}_{size}")
        if offset:
            part = F.coalesce(F.lag(part, offset).over(over), F.lit(0.0))
        total = part if total is None else total + part
    return total


def _keep(df: DataFrame, carry: Sequence[str]) -> DataFrame:
    return df.select("ticker", "date", "close", *carry)


def sma(bars: DataFrame, windows: Sequence[int] = K.MA_WINDOWS, carry: Sequence[str] = ()) -> DataFrame:
    """Simple moving averages; the first rows average what there is."""
    known = F.col("close").isNotNull().cast("double")
    sums = trailing_sums(
        _keep(bars, carry), {"_s": F.coalesce("close", F.lit(0.0)), "_n": known}, windows, by_date()
    )
    averages = [(F.col(f"_s_{n}") / F.nullif(F.col(f"_n_{n}"), F.lit(0.0))).alias(f"sma_{n}") for n in windows]
    return sums.select("ticker", "date", "close", *averages, *carry)


def wma(
    bars: DataFrame, windows: Sequence[int] = K.MA_WINDOWS, carry: Sequence[str] = (), warm_only: bool = True
) -> DataFrame:
    """Linearly weighted moving averages, newest row heaviest.

    The weighted sum over n rows is ``(n - r) * sum(x) + sum(r * x)`` with r
    the row number, so two running quantities serve all windows.  A value is
    NULL until n rows exist and where a close among them is missing;
    ``warm_only`` keeps rows where every window has one, as the stored table does.
    """
    rows = _keep(bars, carry).withColumn("_rn", F.row_number().over(by_date()))
    close = F.coalesce("close", F.lit(0.0))
    known = F.col("close").isNotNull().cast("double")
    sums = trailing_sums(rows, {"_s": close, "_w": close * F.col("_rn"), "_n": known}, windows, by_date())
    averages = []
    for n in windows:
        weighted = (n - F.col("_rn")) * F.col(f"_s_{n}") + F.col(f"_w_{n}")
        averages.append(F.when(F.col(f"_n_{n}") == n, weighted / (n * (n + 1) / 2)).alias(f"wma_{n}"))
    result = sums.select("ticker", "date", "close", *averages, *carry)
    return result.dropna(subset=[f"wma_{n}" for n in windows]) if warm_only else result


def _ema_smoothings(windows: Sequence[int]) -> list[Smoothing]:
    return [Smoothing("close", n, 1, f"ema_{n}") for n in windows]


def ema(bars: DataFrame, windows: Sequence[int] = K.MA_WINDOWS, carry: Sequence[str] = ()) -> DataFrame:
    """Exponential moving averages, seeded with the first close."""
    rows = numbered(_keep(bars, carry), "ticker", "date", "_rn")
    averaged = exponential_averages(rows, "ticker", "date", _ema_smoothings(windows), "_rn")
    return averaged.select("ticker", "date", "close", *[f"ema_{n}" for n in windows], *carry)


def extend_ema(later: DataFrame, state: DataFrame | None = None, windows: Sequence[int] = K.MA_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Averages of bars that follow those the state has seen, and the state after them.

    The history is not read: store the state with the rows of a load, and begin the next load from it.
    """
    smoothings = _ema_smoothings(windows)
    rows = numbered(_keep(later, ()), "ticker", "date", "_rn", state)
    averaged = exponential_averages(rows, "ticker", "date", smoothings, "_rn").where("_rn > 0")
    return averaged.select("ticker", "date", "close", *[s.output for s in smoothings]), next_state(averaged, "ticker", smoothings, "_rn", state)


_MACD_LINES = [Smoothing("close", K.MACD_FAST, K.MACD_FAST, "_fast"), Smoothing("close", K.MACD_SLOW, K.MACD_SLOW, "_slow")]
_MACD_SIGNAL = Smoothing("macd_line", K.MACD_SIGNAL, K.MACD_SIGNAL_SEED_ROW, "signal_line")


def _macd_lines(bars: DataFrame, state: DataFrame | None) -> DataFrame:
    rows, size = numbered(_keep(bars, ()), "ticker", "date", "_rn", state), block_size([*_MACD_LINES, _MACD_SIGNAL])
    lines = exponential_averages(in_blocks(rows, "ticker", "date", "_rn", size), "ticker", "date", _MACD_LINES, "_rn", size)
    lines = lines.withColumn("macd_line", F.col("_fast") - F.col("_slow"))
    return exponential_averages(lines, "ticker", "date", [_MACD_SIGNAL], "_rn", size)


def _with_previous(signalled: DataFrame) -> DataFrame:
    in_order = by_block("ticker", "date")
    return signalled.select(
        "*",
        (F.col("macd_line") - F.col("signal_line")).alias("macd_histogram"),
        F.lag("macd_line").over(in_order).alias("prev_macd_line"),
        F.lag("signal_line").over(in_order).alias("prev_signal_line"),
    )


_MACD = ("ticker", "date", "close", "macd_line", "signal_line", "macd_histogram", "prev_macd_line", "prev_signal_line")


def macd(bars: DataFrame) -> DataFrame:
    """MACD line, signal line and histogram, from the first signal row on."""
    return _with_previous(_macd_lines(bars, None).where(F.col("_rn") >= K.MACD_SIGNAL_SEED_ROW)).select(*_MACD)


def extend_macd(later: DataFrame, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """MACD of bars that follow those the state has seen, from the first signal row on, and the state after them."""
    lines = _macd_lines(later, state)
    after = next_state(lines.where("_rn > 0"), "ticker", [*_MACD_LINES, _MACD_SIGNAL], "_rn", state)
    old = F.col("_rn") == 0
    shown = F.col("_rn") + F.col("_seen") >= K.MACD_SIGNAL_SEED_ROW
    if state is not None:
        # The row before counts from the first signal row on, as in the table itself.
        lines = lines.withColumns(
            {
                "macd_line": F.when(old, F.col("_state._fast") - F.col("_state._slow")).otherwise(F.col("macd_line")),
                "signal_line": F.when(old, F.col("_state.signal_line")).otherwise(F.col("signal_line")),
            }
        )
    return _with_previous(lines.where(shown)).where(~old).select(*_MACD), after


def bollinger(
    averages: DataFrame,
    window: int = K.BOLLINGER_WINDOW,
    width: float = K.BOLLINGER_WIDTH,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Bands around a simple moving average.

    The deviation is taken over the current row and ``window`` rows before it,
    so over one row more than the average.  Apply it after any date filter:
    the deviation sees the filtered rows only.
    """
    spread = F.stddev_samp("close").over(by_date().rowsBetween(-window, 0)) * width
    middle = F.col(f"sma_{window}")
    return averages.withColumn("_spread", spread).select(
        "ticker",
        "date",
        "close",
        middle.alias("middle_band"),
        (middle + F.col("_spread")).alias("upper_band"),
        (middle - F.col("_spread")).alias("lower_band"),
        *carry,
    )
