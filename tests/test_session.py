from __future__ import annotations

import pyarrow as pa
import pytest

from tickloom import session


def full_collections(spark) -> int:
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(bean.getCollectionCount() for bean in beans if "Young" not in bean.getName() and "Concurrent" not in bean.getName())


def test_the_driver_collects_once_its_heap_has_filled(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    with session.Scratch(spark) as scratch:
        monkeypatch.setattr(session, "HEAP_SHARE", 0.0)
        before = full_collections(spark)
        kept = scratch.keep(rows)
        assert full_collections(spark) > before
        assert sorted(kept.collect()) == sorted(rows.collect())
        monkeypatch.setattr(session, "HEAP_SHARE", 1.0)
        before = full_collections(spark)
        scratch.keep(rows)
        assert full_collections(spark) == before


def test_workers_are_handed_batches_of_bounded_size(spark):
    rows = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 1000) AS text")
    sizes = lambda: [r.n for r in rows.mapInArrow(lambda parts: (pa.RecordBatch.from_pydict({"n": [p.nbytes]}) for p in parts), "n long").collect()]
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    assert len(sizes()) == 1
    with pytest.raises(KeyError), session.arrow_batches(spark, 100_000):
        assert len(found := sizes()) > 10 and max(found) <= 110_000
        with session.arrow_batches(spark, 1 << 30):
            assert spark.conf.get(name) == "100000"
        raise KeyError
    assert spark.conf.get(name) == before
