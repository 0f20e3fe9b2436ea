from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import BAR_SCHEMA, bars, column, day, planned, rows
from tickloom.operators import bars as B
from tickloom.operators import indicators as I
from tickloom.plans import upkeep
from tickloom.session import Scratch, freeze


def series(spark, r, gaps=False):
    closes = {t: [None if gaps and r.random() < 0.01 else 50 + r.random() * 20 for _ in range(n)] for t, n in (("A", 300), ("B", 120), ("C", 30), ("D", 1))}
    data = [(t, day(i + (40 if t == "B" else 0)), c, c, c, c, 1.0, 1) for t, values in closes.items() for i, c in enumerate(values)]
    return spark.createDataFrame(data, BAR_SCHEMA)


@pytest.mark.parametrize("gaps", [False, True])
@pytest.mark.parametrize("kind", ["ema", "macd"])
def test_averages_go_on_from_a_stored_state(spark, kind, gaps):
    r = random.Random(3 + gaps)
    table = series(spark, r, gaps)
    extend, whole = {"ema": (I.extend_ema, I.ema), "macd": (I.extend_macd, I.macd)}[kind]
    edges = [-1, 20, 33, 34, 35, 170, 171, 400]
    state, got = None, []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        load = table.where((F.col("date") > day(max(a, 0))) | (F.lit(a) < 0)).where(F.col("date") <= day(b))
        part, state = extend(load, state)
        state = freeze(state)
        got += rows(part)
    expected = rows(whole(table), "ticker", "date")
    got.sort(key=lambda x: x[:2])
    assert [x[:2] for x in got] == [x[:2] for x in expected]
    for one, other in zip(got, expected, strict=True):
        assert [x is None for x in one] == [x is None for x in other]
        assert [x for x in one[2:] if x is not None] == pytest.approx([x for x in other[2:] if x is not None], rel=1e-12, abs=1e-12), (one, other)
    counts = {t: n for t, n in table.groupBy("ticker").count().collect()}
    assert dict(rows(state.select("ticker", "rows"))) == counts


def test_a_day_reads_no_history(spark, tmp_path):
    table = series(spark, random.Random(1))
    table.withColumn("day", F.col("date")).write.partitionBy("day").parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    _, state = I.extend_ema(stored.where(F.col("day") <= day(200)))
    state = freeze(state)
    part, _ = I.extend_ema(stored.where(F.col("day") == day(201)), state)
    plan = planned(part)
    assert "(day#" in plan and str(day(201)) in plan.split("PartitionFilters")[1]
    assert part.count() == 1


def month_rows(months):
    return sorted(tuple(x) for x in months.select("ticker", "year", "month_num", "bars", "record_count", "first_date", "last_date").collect())


def test_late_repeated_and_corrected_bars_give_the_rebuilt_months(spark, tmp_path):
    r = random.Random(5)
    whole = bars(spark, {"A": [float(i) for i in range(100)], "B": [1.0] * 40}).collect()
    r.shuffle(whole)
    corrected = [(*x[:2], *(v + 1 for v in x[2:6]), *x[6:]) for x in whole[:5]]
    loads = [whole[:60], whole[60:90] + whole[:7], corrected, [], whole[90:]]
    path, so_far = str(tmp_path / "months"), []
    for load in loads:
        arrived = spark.createDataFrame(load, BAR_SCHEMA)
        upkeep.update_months(spark, path, arrived)
        so_far += load
        assert month_rows(spark.read.parquet(path)) == month_rows(B.cumulate_months(spark.createDataFrame(so_far, BAR_SCHEMA)))
    plan = planned(upkeep.touched_months(spark.read.parquet(path), [(2024, 2)]))
    assert "month_num" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_late_and_withdrawn_splits_rewrite_their_tickers_alone(spark, tmp_path):
    r = random.Random(8)
    table = bars(spark, {f"T{i}": [r.random() * 90 + 1 for _ in range(30)] for i in range(12)})
    schema = "ticker string, split_from int, split_to int, date date"
    first = [(f"T{i}", 1, 3, day(12)) for i in range(0, 12, 2)]
    late = [("T0", 3, 7, day(5)), ("T3", 1, 7, day(29)), ("T0", 1, 3, day(20))]
    raw, adjusted = str(tmp_path / "raw"), str(tmp_path / "adjusted")
    upkeep.store_bars(table, raw)
    written = {}
    for splits, changed in ((first, None), (first + late, late), (first[1:] + late, first[:1]), (first[1:] + late, [])):
        now = spark.createDataFrame(splits, schema)
        upkeep.refresh_adjusted(spark, raw, adjusted, now, None if changed is None else spark.createDataFrame(changed, schema))
        stored = spark.read.parquet(adjusted)
        rebuilt = B.adjust_for_splits(table, now)
        assert rows(stored.select(*table.columns), "ticker", "date") == rows(rebuilt, "ticker", "date")
        files = {p.parent.name: {q.name for q in p.parent.iterdir()} for p in (tmp_path / "adjusted").rglob("*.parquet")}
        if changed is not None:
            touched = {f"bucket={b}" for b in column(spark.createDataFrame(changed, schema).select(upkeep.bucket()).distinct(), "bucket", "bucket")} if changed else set()
            assert {b for b in files if files[b] != written[b]} == touched
        written = files
    plan = planned(upkeep.touched_bars(spark.read.parquet(adjusted), [1, 2]))
    assert "bucket" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert spark.read.parquet(adjusted).schema["bucket"].dataType == T.IntegerType()


def kept(monkeypatch):
    """Labels of what upkeep stores beside its tables from now on."""
    labels = []

    class Noted(Scratch):
        def keep(self, df, label="frozen", **options):
            labels.append(label)
            return super().keep(df, label, **options)

    monkeypatch.setattr(upkeep, "Scratch", Noted)
    return labels


def test_merged_months_keep_the_others_and_read_the_stored_once(spark, tmp_path, monkeypatch):
    labels, path = kept(monkeypatch), str(tmp_path / "months")
    table = bars(spark, {"A": [float(i) for i in range(40)], "B": [1.0] * 40, "C": [2.0] * 10})
    nobody = spark.createDataFrame([(None, day(3), *[1.0] * 5, 1)], BAR_SCHEMA)
    first, later = table.where("ticker <> 'C'").unionByName(nobody), table.where("ticker <> 'B'")
    upkeep.update_months(spark, path, first)
    assert labels == []
    stored = spark.read.parquet(path)
    merged = B.merge_months(stored, later)
    assert month_rows(merged.where("ticker IS NOT NULL")) == month_rows(B.cumulate_months(first.unionByName(later)).where("ticker IS NOT NULL"))
    assert merged.where("ticker IS NULL").count() == 1 and planned(merged).count("FileScan parquet") == 1
    expected = month_rows(merged.where("ticker IS NOT NULL"))
    upkeep.update_months(spark, path, later)
    assert labels == ["arrived"]
    assert month_rows(spark.read.parquet(path).where("ticker IS NOT NULL")) == expected


def test_adjusted_bars_are_written_once(spark, tmp_path, monkeypatch):
    labels, raw, adjusted = kept(monkeypatch), str(tmp_path / "raw"), str(tmp_path / "adjusted")
    table = bars(spark, {f"T{i}": [8.0] * 20 for i in range(5)})
    upkeep.store_bars(table, raw)
    splits = spark.createDataFrame([("T1", 1, 2, day(9)), ("T3", 1, 4, day(5))], "ticker string, split_from int, split_to int, date date")
    upkeep.refresh_adjusted(spark, raw, adjusted, splits.limit(0))
    upkeep.refresh_adjusted(spark, raw, adjusted, splits, splits)
    assert labels == ["tickers"]
    assert rows(spark.read.parquet(adjusted).select(*table.columns), "ticker", "date") == rows(B.adjust_for_splits(table, splits), "ticker", "date")
