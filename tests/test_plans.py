from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tests.helpers import planned, rows
from tickloom.plans.marts import STORED, Marts
from tickloom.workload.queries import QUERIES
from tickloom.workload.tables import Tables
from tools.check import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    if name not in entry.oracle_sql():
        assert ours.num_rows > 0
        return
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    theirs = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    a, b = canonical(ours), canonical(theirs)
    assert len(a) == len(b)
    assert a.equals(b)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_query_joins_without_a_key(spark):
    for name in ("a5_classifier", "a9_candlestick_weekly", "a11_market_leader", "a23_normalised_performance", "f10_time_periods", "q5_outliers", "w1_sma_mart"):
        plan = planned(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_stored_tables_equal_lazy_ones(spark, tables, tmp_path):
    lazy, stored = Marts(tables, True), Marts(tables, True)
    stored.save_all(str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(STORED)
    for name in ("classified", "earnings", "grades"):
        columns = sorted(getattr(lazy, name).columns)
        assert rows(getattr(lazy, name).select(columns).orderBy(columns)) == rows(getattr(stored, name).select(columns).orderBy(columns))
    assert stored.sma.count() == lazy.daily.count()
    assert "FileScan parquet" in planned(stored.sma)


def test_a_stored_table_is_not_written_over_itself(spark, tmp_path):
    schema = "ticker string, name string, primary_exchange string"
    marts = Marts({})
    marts.__dict__["classified"] = spark.createDataFrame([("A", "a", "X")], schema)
    marts.save("classified", str(tmp_path))
    with pytest.raises(ValueError, match="is read from"):
        marts.save("classified", str(tmp_path))
    assert marts.classified.count() == 1
