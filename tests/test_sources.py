from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tickloom
from tests.helpers import bars, column, day, executed_plan, planned, rows
from tickloom import schemas
from tickloom.session import shared_dir
from tickloom.sources import normalize as N
from tickloom.sources import readers as R
from tickloom.sources import writers as WR


def documents(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "value string")


def test_bulk_csv(spark, tmp_path):
    folder = tmp_path / "2024" / "01"
    folder.mkdir(parents=True)
    (folder / "x.csv").write_text(
        "ticker,volume,open,close,high,low,window_start,transactions\n"
        "A,100,1.5,2.5,3.5,0.5,1704171600000000000,7\nB,,1,2,3,0,1704171600000000000,\n"
    )
    got = R.read_bars_csv(spark, f"{tmp_path}/*/*/*.csv")
    assert rows(got, "ticker") == [
        ("A", 100.0, 1.5, 3.5, 0.5, 2.5, 7, dt.date(2024, 1, 2)),
        ("B", None, 1.0, 3.0, 0.0, 2.0, None, dt.date(2024, 1, 2)),
    ]


def test_seed(spark):
    path = Path(tickloom.__file__).parent / "data" / "country_codes.csv"
    assert R.read_seed(spark, str(path)).count() == 10


def test_daily_response(spark):
    got = N.normalize_daily_json(
        documents(
            spark,
            {"results": [{"T": "A", "v": 1.0, "o": 2.0, "c": 3.0, "h": 4.0, "l": 1.0, "t": 1704142800000, "n": 5}, {"T": "B"}]},
            {"status": "none"},
        )
    )
    assert rows(got, "ticker") == [
        ("A", 1.0, 2.0, 3.0, 4.0, 1.0, dt.date(2024, 1, 1), 5),
        ("B", None, None, None, None, None, None, None),
    ]


def test_ticker_details(spark):
    details = {"request_id": "r", "status": "OK", "results": {"name": "N", "type": "CS", "market_cap": 5.0, "branding": {"icon_url": "i"}}}
    got = N.parse_ticker_details(documents(spark, {"A": details, "B": {"status": "NOT_FOUND"}}))
    found = {r.ticker: r for r in got.collect()}
    assert found["A"].branding_icon_url == "i" and found["A"].branding_logo_url is None and found["A"].market_cap == 5.0
    assert found["B"].type is None


def test_news(spark):
    parsed = N.parse(
        documents(
            spark,
            {"published_utc": "2024-01-02T23:59:00Z", "article_url": "u", "insights": [{"ticker": "A", "sentiment": "mixed", "sentiment_reasoning": "r"}, {"ticker": "B"}]},
            {"published_utc": "2024-01-03T00:00:00Z", "article_url": "w", "insights": []},
            {"published_utc": "2024-01-03T00:00:00Z", "article_url": "x"},
        ),
        schemas.NEWS_ITEM,
    )
    assert rows(N.flatten_news(parsed), "article_url") == [
        ("A", "mixed", "r", dt.date(2024, 1, 2), "u"),
        (None, None, None, dt.date(2024, 1, 3), "w"),
        (None, None, None, dt.date(2024, 1, 3), "x"),
    ]


def test_field_mappings(spark):
    splits = N.map_splits(N.parse(documents(spark, {"execution_date": "2024-01-02", "split_from": "1", "split_to": "x", "ticker": "A"}), schemas.SPLIT_ITEM))
    assert rows(splits) == [("A", 1, None, dt.date(2024, 1, 2))]
    grades = N.map_grades(N.parse(documents(spark, {"date": "2024-01-02", "newGrade": "Buy"}, {"symbol": "A", "date": "2024-01-02"}), schemas.GRADE_ITEM))
    assert column(grades, "ticker", "ticker") == ["A"]
    surprises = N.map_surprises(N.parse(documents(spark, {"symbol": "A", "period": "2024-03-31", "actual": 1.0}), schemas.SURPRISE_ITEM))
    assert surprises.first().date == dt.date(2024, 3, 31)


def test_slice_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, {"A": [1.0] * 10, "B": [1.0] * 10}).write.partitionBy("date").parquet(path)
    got = R.read_slice(spark.read.parquet(path), "A", "2024-01-03", "2024-01-05")
    assert got.count() == 3
    plan = executed_plan(got)
    assert "EqualTo(ticker,A)" in plan and "PartitionFilters: [isnotnull(date" in plan
    assert R.read_slice(spark.read.parquet(path)).count() == 20


def test_clustered_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark, {"A": [1.0] * 3, "B": [2.0]})
    WR.write_clustered(df, path, "fail", ("ticker", "date"))
    with pytest.raises(FileExistsError):
        WR.write_clustered(df, path, "fail", ("ticker",))
    with pytest.raises(ValueError, match="missing"):
        WR.write_clustered(df, path, "append", ("nothing",))
    with pytest.raises(ValueError, match="mode"):
        WR.write_clustered(df, path, "replace")
    WR.write_clustered(df, path, "append", ("ticker",))
    assert spark.read.parquet(path).count() == 8
    WR.write_clustered(df, path, "overwrite", ("ticker",), ("date",))
    assert spark.read.parquet(path).count() == 4


def test_replacing_days_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark, {"A": [1.0, 2.0, 3.0], "B": [4.0, 5.0, 6.0]})
    WR.replace_partitions(df, path)
    fresh = df.where(F.col("date") == day(1)).where("ticker = 'A'").withColumn("close", F.lit(9.0))
    for _ in range(2):
        WR.replace_partitions(fresh, path)
    stored = spark.read.parquet(path)
    assert rows(stored.select("ticker", "date", "close"), "date", "ticker") == [
        ("A", day(0), 1.0), ("B", day(0), 4.0), ("A", day(1), 9.0), ("A", day(2), 3.0), ("B", day(2), 6.0),
    ]


def test_replace_only_with_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark, {"A": [1.0]})
    assert WR.replace_if_nonempty(df, path)
    assert not WR.replace_if_nonempty(df.limit(0), path)
    assert spark.read.parquet(path).count() == 1


def test_a_replaced_table_may_be_read_by_its_load_and_survives_a_failed_one(spark, tmp_path):
    path = str(tmp_path / "t")
    WR.replace_if_nonempty(bars(spark, {"A": [1.0]}), path)
    stored = spark.read.parquet(path)
    assert WR.replace_if_nonempty(stored.unionByName(stored), path) and spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    # Failed after the old table was moved away, and after the new one had taken its place.
    (tmp_path / "t").rename(tmp_path / "t-previous")
    assert not WR.replace_if_nonempty(bars(spark, {"A": [1.0]}).limit(0), path) and spark.read.parquet(path).count() == 2
    bars(spark, {"B": [1.0] * 3}).write.parquet(path + "-previous")
    assert WR.replace_if_nonempty(bars(spark, {"A": [1.0] * 4}), path) and spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark, {"A": [1.0, 2.0], "B": [3.0, 4.0]}).select("ticker", "date", "close")
    update = spark.createDataFrame([("A", day(1), 20.0), ("C", day(5), 5.0)], df.schema)
    WR.upsert(df, path, ("ticker", "date"), "date")
    for _ in range(2):
        WR.upsert(update, path, ("ticker", "date"), "date")
    stored = spark.read.schema(df.schema).parquet(path)
    assert rows(stored.select("ticker", "date", "close"), "date", "ticker") == [
        ("A", day(0), 1.0), ("B", day(0), 3.0), ("A", day(1), 20.0), ("B", day(1), 4.0), ("C", day(5), 5.0),
    ]
    with pytest.raises(ValueError):
        WR.upsert(df, path, ("ticker",), "date")


def test_upsert_takes_the_last_record_of_a_key_and_leaves_no_scratch(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "ticker string, date date, close double, record int"
    days = spark.createDataFrame([("A", day(0), 1.0, 0), ("B", None, 2.0, 0), ("A", day(1), 3.0, 0)], schema)
    WR.upsert(days, path, ("ticker", "date"), "date", "record")
    updates = spark.createDataFrame([("A", day(1), 5.0, 2), ("A", day(1), 4.0, 1), ("C", day(1), 7.0, 1), ("C", day(1), 6.0, 0)], schema)
    before = set(Path(shared_dir(spark).removeprefix("file:")).glob("updates-*"))
    WR.upsert(updates, path, ("ticker", "date"), "date", "record")
    assert set(Path(shared_dir(spark).removeprefix("file:")).glob("updates-*")) == before
    stored = spark.read.schema(schema).parquet(path).select("ticker", "date", "close")
    assert sorted(rows(stored), key=str) == sorted([("A", day(0), 1.0), ("B", None, 2.0), ("A", day(1), 5.0), ("C", day(1), 7.0)], key=str)
    with pytest.raises(ValueError, match="repeat"):
        WR.upsert(updates, path, ("ticker", "date"), "date")


def test_upsert_reads_only_the_partitions_it_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark, {"A": [1.0, 2.0, 3.0]}).select("ticker", "date", "close")
    WR.upsert(df, path, ("ticker", "date"), "date")
    stored = spark.read.schema(df.schema).parquet(path)
    plan = planned(WR.touched_partitions(stored, "date", [day(1)]))
    assert "PartitionFilters: [isnotnull(date" in plan and str(day(1)) in plan
    assert len(WR.touched_partitions(stored, "date", [day(1)]).inputFiles()) == 3
    assert WR.touched_partitions(stored, "date", [day(1)]).count() == 1


def test_incremental_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = bars(spark, {"A": [1.0, 2.0, 3.0]}).select("ticker", "date", "close")
    WR.incremental_append(df.where(F.col("date") < day(2)), path)
    WR.incremental_append(df, path)
    WR.incremental_append(df, path)
    assert column(spark.read.parquet(path), "close", "date") == [1.0, 2.0, 3.0]
    assert WR.newer_than(df, df.limit(0)).count() == 3


def test_newest_stored_day_is_known_from_the_folders(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    df = bars(spark, {"A": [1.0, 2.0, 3.0]}).select("ticker", "date", "close")
    WR.incremental_append(df.where(F.col("date") < day(2)), path)
    newest = WR.newest_stored(spark, path, df)
    plan = planned(WR.newer_than(df, newest))
    assert "FileScan" not in plan
    assert rows(newest) == [(day(1),)]
    # A table without partitions stays as it is.
    df.where(F.col("date") < day(1)).write.parquet(plain)
    for _ in range(2):
        WR.incremental_append(df, plain)
    assert column(spark.read.parquet(plain), "close", "date") == [1.0, 2.0, 3.0]
    assert WR.stored_values(spark, plain, WR.LOADED_UPTO) == []
    # Nothing newer leaves no folder; rows without a day are in no load.
    more = df.unionByName(spark.createDataFrame([("B", None, 9.0), ("B", day(2), 8.0)], df.schema))
    for load in (df.where(F.col("date") < day(2)), df.limit(0), more, more):
        WR.incremental_append(load, path)
    assert WR.stored_values(spark, path, WR.LOADED_UPTO) == [str(day(1)), str(day(2))]
    assert column(spark.read.parquet(path), "close", "date", "close") == [1.0, 2.0, 3.0, 8.0]


def test_json_records(spark):
    df = spark.createDataFrame([("A", None)], "TICKER string, Close double")
    assert rows(WR.to_json_records(df)) == [('{"ticker":"A","close":null}',)]
