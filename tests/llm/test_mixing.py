from __future__ import annotations

import random
import re

import duckdb
import pytest

from tests.llm.helpers import documents, prose
from tickloom.llm import mixing, sql
from tickloom.session import Scratch


def rows_and_sources():
    r = random.Random(2)
    rows, sources = [], []
    for i in range(400):
        rows.append((i, " ".join(prose(r, r.randrange(0, 40)))))
        sources.append(r.choice(["a", "a", "a", "b", "é", "Z", None, "tiny" if i < 30 else "a"]))
    rows += [(1000, None), (1000, None), (None, "x y"), (None, None), (1001, ""), (1002, "a " * 5000)]
    sources += ["nothing", "nothing", "b", "b", "", "b"]
    return rows, sources


def reference_targets(sizes: dict) -> dict:
    """The excess above twice a source's size is shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_equal_to_sql_and_near_targets(spark):
    rows, sources = rows_and_sources()
    df = documents(spark, rows, sources)
    ours = mixing.mix_sources(Scratch(spark), df)
    duck = duckdb.connect()
    duck.register("documents", df.select("doc_id", "text", "source").toArrow())
    theirs = duck.sql(f"SELECT {', '.join(ours.columns)} FROM ({sql.OP6})").fetchall()
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(theirs, key=str)
    found = ours.toPandas()
    sizes = {}
    for (_, text), s in zip(rows, sources, strict=True):
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))
    expected = reference_targets(sizes)
    largest = found.groupby("source", dropna=False)["size"].max()
    for s, group in found.groupby("source", dropna=False):
        s = None if s != s else s
        assert group["target"].iloc[0] == pytest.approx(expected[s])
        assert abs(group["taken"].sum() - expected[s]) <= max(largest.get(s, largest.max()), 40)
        assert (group["taken"] <= 2 * group["size"]).all()


def test_mixed_rows_follow_the_plan_and_reruns_agree(spark):
    rows, sources = rows_and_sources()
    df = documents(spark, rows, sources)
    plan = mixing.mix_sources(Scratch(spark), df)
    mixed = mixing.mixed_rows(Scratch(spark), df)
    assert mixed.columns == df.columns
    assert mixed.count() == plan.agg({"copies": "sum"}).first()[0]
    again = mixing.mixed_rows(Scratch(spark), df.repartition(5))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))


def test_no_rows_and_no_words(spark):
    assert mixing.mix_sources(Scratch(spark), documents(spark, [])).collect() == []
    only = mixing.mix_sources(Scratch(spark), documents(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in only] == [(0, 0, 0.0)] * 2


def test_many_sources_are_numbered_in_ranges(spark):
    r = random.Random(3)
    sizes = {f"s{i}": r.randrange(0, 2000) for i in range(1500)} | {None: 40, "": 0, "large": 3_000_000}
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        with Scratch(spark) as scratch:
            found = mixing.targets(scratch, totals, 150, 2)
            plan = found._jdf.queryExecution().executedPlan().toString()
            got = {x["source"]: x["target"] for x in found.collect()}
            ranges = [spark.read.parquet(p).select("range").distinct().count() for p in scratch.paths if "ranges" in p]
    finally:
        spark.conf.set(coalesce, before)
    assert got == pytest.approx(reference_targets(sizes))
    assert len(ranges) == 2 and min(ranges) > 1
    # No window over the sources is without a partition.
    assert "Window" not in plan


def test_repeated_rows_are_counted_off(spark, monkeypatch):
    # Ten rows of 4 words at a target of 67.5: 17 rows weigh 68, the nearest there is.
    monkeypatch.setattr(mixing, "TIED_ROWS", 3)
    rows = [(7, "a b c d")] * 10 + [(8, "a b c")] * 90 + [(9, "x")] * 3
    sources = ["a"] * 10 + ["b"] * 90 + ["c"] * 3
    df = documents(spark, rows, sources).repartition(4)
    found = mixing.mix_sources(Scratch(spark), df).toPandas()
    assert len(found) == len(rows)
    for source, group in found.groupby("source"):
        size, target = group["size"].iloc[0], group["target"].iloc[0]
        assert abs(group["taken"].sum() - target) <= size / 2
        assert (group["taken"] <= 2 * size).all()
    mixed = mixing.mixed_rows(Scratch(spark), df)
    assert mixed.columns == df.columns
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts == found.groupby("source")["copies"].sum().to_dict()
    again = mixing.mix_sources(Scratch(spark), df.repartition(7)).toPandas()
    order = list(found.columns)
    assert sorted(map(tuple, found[order].to_numpy().tolist())) == sorted(map(tuple, again[order].to_numpy().tolist()))
    # All in one source, more rows than a stretch holds.
    one = mixing.mix_sources(Scratch(spark), documents(spark, [(1, "w w w")] * 101)).toPandas()
    assert abs(one["taken"].sum() - 1.5 * 303) <= 1.5 and set(one["copies"]) == {1, 2}
