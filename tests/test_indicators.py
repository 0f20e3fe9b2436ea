from __future__ import annotations

import datetime as dt
import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tests.helpers import BAR_SCHEMA, bars, column, day, planned, rows
from tickloom import session
from tickloom.operators import indicators as I
from tickloom.operators.recurrence import Smoothing, exponential_averages
from tickloom.session import freeze

CLOSES = [float(i) for i in range(1, 41)]


def smooth(values, span, seed):
    """Reference recursion: NULL before the seed row (counted from 1)."""
    out, current = [], None
    for i, x in enumerate(values, 1):
        if i < seed:
            out.append(None)
            continue
        current = x if i == seed else current + (x - current) * 2 / (span + 1)
        out.append(current)
    return out


def assert_close(got, expected, rel):
    """Equal up to a relative error, missing values in the same places."""
    assert [x is None for x in got] == [x is None for x in expected]
    assert [x for x in got if x is not None] == pytest.approx([x for x in expected if x is not None], rel=rel)


def test_sma_averages_what_there_is(spark):
    got = I.sma(bars(spark, {"A": CLOSES, "B": [5.0] * 7}), windows=(3, 10))
    assert column(got.where("ticker = 'A'"), "sma_3", "date")[:4] == [1.0, 1.5, 2.0, 3.0]
    assert column(got.where("ticker = 'A'"), "sma_10", "date")[-1] == pytest.approx(35.5)
    assert column(got.where("ticker = 'B'"), "sma_10", "date") == [5.0] * 7


def test_sma_ignores_missing_closes(spark):
    b = bars(spark, {"A": [1.0, 2.0, 3.0]}).withColumn("close", F.when(F.col("close") != 2, F.col("close")))
    assert column(I.sma(b, windows=(2,)), "sma_2", "date") == [1.0, 1.0, 3.0]


@pytest.mark.parametrize("windows", [(10, 20, 50, 100, 200), (3, 7), (5, 10, 12, 15), (4,)])
def test_trailing_sums_equal_sliding_frames(spark, windows):
    values = [math.sin(i) * 10 + i for i in range(230)]
    b = bars(spark, {"A": values})
    sums = I.trailing_sums(b, {"s": F.col("close")}, windows, I.by_date())
    for n in windows:
        expected = [sum(values[max(0, i + 1 - n) : i + 1]) for i in range(len(values))]
        assert column(sums, f"s_{n}", "date") == pytest.approx(expected)


def test_wma_needs_a_full_window(spark):
    got = I.wma(bars(spark, {"A": [1.0, 2.0, 4.0, 8.0, 16.0]}), windows=(3,), warm_only=False)
    values = column(got, "wma_3", "date")
    assert values[:2] == [None, None]
    assert values[2] == pytest.approx((3 * 4 + 2 * 2 + 1 * 1) / 6)
    assert values[4] == pytest.approx((3 * 16 + 2 * 8 + 1 * 4) / 6)


def test_wma_mart_keeps_rows_with_every_window(spark):
    got = I.wma(bars(spark, {"A": CLOSES}), windows=(5, 30))
    assert got.count() == 11


def test_ema_starts_at_the_first_close(spark):
    got = I.ema(bars(spark, {"A": CLOSES, "B": CLOSES[::-1]}), windows=(10, 200))
    for t, values in (("A", CLOSES), ("B", CLOSES[::-1])):
        for n in (10, 200):
            assert column(got.where(F.col("ticker") == t), f"ema_{n}", "date") == pytest.approx(smooth(values, n, 1))


def test_macd_seeds_are_single_values(spark):
    got = I.macd(bars(spark, {"A": CLOSES}))
    fast, slow = smooth(CLOSES, 12, 12), smooth(CLOSES, 26, 26)
    line = [None if s is None else f - s for f, s in zip(fast, slow)]
    signal = smooth([0 if x is None else x for x in line], 9, 34)
    table = rows(got.select("date", "macd_line", "signal_line", "macd_histogram", "prev_macd_line"), "date")
    assert [r[0] for r in table] == [day(i) for i in range(33, 40)]
    assert [r[1] for r in table] == pytest.approx(line[33:])
    assert [r[2] for r in table] == pytest.approx(signal[33:])
    assert table[0][3] == 0.0 and table[0][4] is None
    assert table[1][4] == pytest.approx(line[33])


def test_a_constant_series_averages_to_itself(spark):
    b = bars(spark, {"A": [0.1 + 0.2] * 400})
    averages = I.ema(b, windows=(10, 200))
    assert averages.where("ema_10 <> close or ema_200 <> close").count() == 0
    assert I.macd(b).where("macd_line <> 0 or signal_line <> 0").count() == 0


def test_noise_decides_no_comparison(spark):
    # The price moves once and then stays: the averages end up at the price.
    values = [10.0] * 5 + [11.3] * 700
    got = I.ema(bars(spark, {"A": values}), windows=(10, 20))
    from tickloom.operators import signals

    crossings = signals.cross_signal(got, "close", "ema_10", tolerance=1e-12).where("signal is not null")
    assert column(crossings, "signal", "date") == ["BUY"]


def test_macd_of_a_short_series_is_empty(spark):
    assert I.macd(bars(spark, {"A": CLOSES[:33]})).count() == 0


def test_bollinger_spans_one_row_more_than_the_average(spark):
    averages = I.sma(bars(spark, {"A": [1.0, 4.0, 9.0, 16.0, 25.0]}), windows=(2,))
    got = rows(I.bollinger(averages, 2, 2.0).select("middle_band", "upper_band", "lower_band"), "middle_band")
    assert got[0] == (1.0, None, None)
    spread = 2 * statistics.stdev([9.0, 16.0, 25.0])
    assert got[-1] == pytest.approx((20.5, 20.5 + spread, 20.5 - spread))


@pytest.mark.parametrize("block", [40, 100, None])
def test_recurrence_in_blocks_equals_recursion(spark, block):
    values = [100 + 20 * math.sin(i / 3) + (i % 7) for i in range(300)]
    b = bars(spark, {"A": values}).withColumn("rn", F.row_number().over(W.partitionBy("ticker").orderBy("date")))
    specs = [Smoothing("close", 2, 1, "short"), Smoothing("close", 5, 5, "mid"), Smoothing("close", 9, 26, "long")]
    got = exponential_averages(b, "ticker", "date", specs, "rn", block=block)
    for s in specs:
        assert_close(column(got, s.output, "date"), smooth(values, s.span, s.seed_row), 1e-12)


def test_recurrence_of_a_long_series(spark):
    n = 7000
    frame = spark.range(1, n + 1).select(
        F.lit("A").alias("ticker"), F.col("id").alias("date"), F.col("id").alias("rn"),
        (F.lit(100.0) + F.pmod(F.col("id") * 37, F.lit(101))).alias("close"),
    )
    got = exponential_averages(frame, "ticker", "date", [Smoothing("close", 10, 1, "e"), Smoothing("close", 200, 1, "f"), Smoothing("close", 2000, 1, "g")], "rn")
    values = [100.0 + (i * 37) % 101 for i in range(1, n + 1)]
    assert column(got, "e", "date") == pytest.approx(smooth(values, 10, 1), rel=1e-12)
    assert column(got, "f", "date") == pytest.approx(smooth(values, 200, 1), rel=1e-12)
    assert column(got, "g", "date") == pytest.approx(smooth(values, 2000, 1), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.floats(0.01, 1e5), min_size=1, max_size=90),
    span=st.integers(2, 6),
    seed=st.integers(1, 5),
)
def test_recurrence_property(spark, values, span, seed):
    b = bars(spark, {"A": values}).withColumn("rn", F.row_number().over(W.partitionBy("ticker").orderBy("date")))
    got = exponential_averages(b, "ticker", "date", [Smoothing("close", span, seed, "e")], "rn", block=32)
    assert_close(column(got, "e", "date"), smooth(values, span, seed), 1e-9)


def test_one_shuffle_serves_a_chain_of_indicators(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, {"A": CLOSES, "B": CLOSES}).write.parquet(path)
    stored = spark.read.parquet(path)
    for table in (I.sma(stored), I.wma(stored), I.ema(stored), I.macd(stored), I.bollinger(I.sma(stored))):
        plan = planned(table)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "ReadSchema: struct<ticker:string,date:date,close:double>" in plan


def test_a_missing_close_leaves_no_made_up_value(spark):
    closes = [101.0 + i for i in range(11)]
    closes[4] = None
    frame = bars(spark, {"A": [0.0] * 11}).drop("close")
    known = spark.createDataFrame([(day(i), c) for i, c in enumerate(closes)], "date date, close double")
    frame = frame.join(known, "date")
    ema = column(I.ema(frame, windows=(3,)), "ema_3", "date")
    expected = [101.0]
    for c in closes[1:4]:
        expected.append((c - expected[-1]) * 0.5 + expected[-1])
    assert ema[:4] == expected and ema[4:] == [None] * 7
    wma = column(I.wma(frame, windows=(3,), warm_only=False), "wma_3", "date")
    assert [x is None for x in wma] == [True, True, False, False, True, True, True, False, False, False, False]
    assert wma[7] == pytest.approx((closes[5] + 2 * closes[6] + 3 * closes[7]) / 6)
    macd = I.macd(frame.withColumn("close", F.when(F.col("date") != day(4), F.col("close"))))
    assert macd.count() == 0


def test_a_first_value_far_from_the_rest_keeps_its_weight(spark):
    closes = [1e6] + [1.0 + (i % 7) for i in range(3000)]
    found = column(I.ema(bars(spark, {"A": closes}), windows=(10, 200)), "ema_200", "date")
    value = closes[0]
    for c in closes[1:]:
        value = (c - value) * (2 / 201) + value
    assert found[-1] == pytest.approx(value, rel=1e-6)


def test_averages_of_a_chain_sort_their_rows_twice(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, {"A": CLOSES, "B": CLOSES}).write.parquet(path)
    stored = spark.read.parquet(path)
    _, state = I.extend_macd(stored)
    state.write.parquet(str(tmp_path / "state"))
    later, _ = I.extend_macd(stored.withColumn("date", F.date_add("date", 1000)), spark.read.parquet(str(tmp_path / "state")))
    for table in (I.ema(stored), I.macd(stored), later):
        plan = planned(table)
        assert plan.count("Sort [") == 2
        assert plan.count("Exchange hashpartitioning") == 1


def test_loads_share_one_derivation_of_the_bars(spark, tmp_path):
    from tickloom.workload.queries import _by_loads

    path = str(tmp_path / "bars")
    days = [dt.date(1994, 6, 28) + dt.timedelta(days=12 * i) for i in range(100)]
    values = [50.0 + i % 13 for i in range(100)]
    bars(spark, {"A": values, "B": values[:40]}, days).write.parquet(path)
    stored = spark.read.parquet(path)
    got = _by_loads(stored, I.extend_ema)
    assert not any("/bars/" in f for f in got.inputFiles())
    whole = rows(I.ema(stored), "ticker", "date")
    for one, other in zip(rows(got, "ticker", "date"), whole, strict=True):
        assert one[:3] == other[:3] and one[3:] == pytest.approx(other[3:], rel=1e-12)


def test_a_larger_input_is_averaged_in_more_tasks(spark, tmp_path, monkeypatch):
    data = [(t, day(i), *[10.0 + (i * k) % 7] * 4, 1.0, 1) for k, t in enumerate("ABCDEFGH") for i in range(60)]
    spark.createDataFrame([*data, (None, day(1), *[1.0] * 4, 1.0, 1)], BAR_SCHEMA).write.parquet(str(tmp_path / "some bars"))
    stored = spark.read.parquet(str(tmp_path / "some bars"))
    size = sum(f.stat().st_size for f in (tmp_path / "some bars").glob("*.parquet"))
    assert session.input_bytes(stored) == size and session.input_bytes(spark.range(3)) == 0
    few = {build: rows(build(stored), "ticker", "date") for build in (I.ema, I.macd)}
    assert "REPARTITION_BY_NUM" not in planned(I.ema(stored))
    monkeypatch.setattr(session, "GATHERED_BYTES", -(-size // 40))
    for build, expected in few.items():
        assert "Exchange hashpartitioning(ticker" in planned(build(stored)) and ", 40), REPARTITION_BY_NUM" in planned(build(stored))
        assert rows(build(stored), "ticker", "date") == expected
    state = freeze(I.extend_macd(stored.where(F.col("date") <= day(40)))[1])
    later, _ = I.extend_macd(stored.where(F.col("date") > day(40)), state)
    assert rows(later.select("ticker", "date"), "ticker", "date") == [r[:2] for r in few[I.macd] if r[1] > day(40)]
