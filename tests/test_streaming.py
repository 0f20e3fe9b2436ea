from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import column, rows
from tickloom.streaming import sinks
from tickloom.streaming import ticks as S
from tickloom.streaming.velocity import read_velocities, start_velocities, velocities_to_end

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def event(symbol: str, second: float, price: float, ingest_id: int, **other):
    ms = int((START.timestamp() + second) * 1000)
    base = {
        "symbol": symbol, "event_type": "A", "start_timestamp": ms, "open": price, "high": price, "low": price,
        "close": price, "volume": 10.0, "vwap": price, "ingest_id": ingest_id,
    }
    return {**base, **other}


class Feed:
    """A folder of event files that a stream reads one by one, in order."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, folder, 0

    def add(self, *events):
        path = self.folder / f"{self.count:04d}.json"
        path.write_text("\n".join(json.dumps(e) for e in events))
        # Files are taken by age.
        os.utime(path, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1
        return self

    def ticks(self, delay: str | None = None):
        parsed = S.parse_ticks(S.read_events(self.spark, "json", path=str(self.folder), maxFilesPerTrigger="1"))
        return parsed.withWatermark("ts", delay) if delay else parsed


@pytest.fixture
def feed(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    return Feed(spark, folder)


def at(second: float) -> dt.datetime:
    return (START + dt.timedelta(seconds=second)).replace(tzinfo=None)


def test_parse_keeps_aggregates_and_drops_zero_vwap(spark, feed):
    feed.add(event("A", 0, 1.0, 1, vwap=0.0), event("B", 0, 1.0, 2, event_type="T"), event("C", 1, 2.0, 3))
    got = sinks.run_to_end(feed.ticks(), "parsed")
    assert rows(got.select("symbol", "vwap"), "symbol") == [("A", None), ("C", 2.0)]


def test_series(spark, feed):
    feed.add(event("A", 0, 1.0, 1, vwap=0.0))
    got = sinks.run_to_end(S.series(feed.ticks()), "series")
    assert column(got, "metric", "metric") == ["close", "high", "low", "open", "volume"]


def test_latest_value_over_batches(spark, feed):
    feed.add(event("A", 5, 1.0, 1), event("B", 1, 7.0, 2))
    feed.add(event("A", 3, 2.0, 3))  # older than what is known
    feed.add(event("A", 5, 4.0, 4))  # same time, arrived later
    got = sinks.run_to_end(S.latest_values(feed.ticks()), "latest", ["symbol"])
    assert rows(got.select("symbol", "price", "ts"), "symbol") == [("A", 4.0, at(5)), ("B", 7.0, at(1))]


def test_a_stream_without_events_is_empty(spark, feed):
    assert sinks.run_to_end(S.latest_values(feed.ticks()), "nothing", ["symbol"]).count() == 0
    assert sinks.run_to_end(S.symbols(feed.ticks()), "nothing").count() == 0


def test_symbols_once(spark, feed):
    feed.add(event("A", 0, 1.0, 1)).add(event("A", 1, 1.0, 2), event("B", 1, 1.0, 3))
    assert column(sinks.run_to_end(S.symbols(feed.ticks()), "symbols"), "symbol", "symbol") == ["A", "B"]


def test_update_messages(spark, feed):
    feed.add(event("A", 0, 1.5, 1, vwap=0.0))
    row = sinks.run_to_end(S.update_messages(feed.ticks()), "updates").first()
    message = json.loads(row.message)
    assert row.channel == "updates:A"
    assert list(message) == ["symbol", "price", "timestamp", "open", "high", "low", "volume", "vwap"]
    assert (message["price"], message["vwap"], message["timestamp"]) == (1.5, 0.0, int(START.timestamp() * 1000))


def test_windows_close_with_the_watermark(spark, feed):
    feed.add(event("A", 0, 1.0, 1), event("A", 5, 2.0, 2), event("B", 6, 2.0, 3))
    # Rows count as late one batch after the watermark has passed them.
    feed.add(event("A", 30, 3.0, 4)).add(event("A", 31, 3.0, 6))
    feed.add(event("A", 2, 9.0, 5))  # late by now: dropped
    rate = sinks.run_to_end(S.message_rate(feed.ticks("10 seconds"), "10 seconds", "5 seconds"), "rate")
    got = rows(rate.where("window_start = '2024-01-01 00:00:00'").select("symbol", "messages"), "symbol")
    assert got == [("A", 2), ("B", 1)]
    candles = sinks.run_to_end(S.tick_candles(feed.ticks("10 seconds"), "10 seconds"), "candles")
    assert rows(candles.drop("window_start"), "symbol") == [("A", 1.0, 2.0, 1.0, 2.0, 20.0), ("B", 2.0, 2.0, 2.0, 2.0, 10.0)]
    active = sinks.run_to_end(S.active_symbols_exact(feed.ticks("10 seconds"), "10 seconds"), "active")
    assert column(active, "active_symbols", "window_start") == [2]
    average = sinks.run_to_end(S.tick_moving_average(feed.ticks("10 seconds"), "10 seconds", "10 seconds"), "average")
    assert rows(average.select("symbol", "average", "ticks"), "symbol") == [("A", 1.5, 2), ("B", 2.0, 1)]


def test_keep_last_of_equal_times(spark, feed):
    feed.add(event("A", 0, 1.0, 1)).add(event("A", 0, 2.0, 2), event("A", 0, 1.5, 0)).add(event("A", 60, 3.0, 3))
    got = sinks.run_to_end(S.keep_last(feed.ticks("10 seconds")), "last")
    assert rows(got.select("symbol", "ts", "close", "ingest_id")) == [("A", at(0), 2.0, 2)]


def test_exact_repeats(spark, feed):
    feed.add(event("A", 0, 1.0, 1), event("A", 0, 1.0, 2)).add(event("A", 0, 1.0, 3), event("A", 1, 1.0, 4))
    assert sinks.run_to_end(S.drop_exact_repeats(feed.ticks("10 seconds")), "repeats").count() == 2


def test_velocity_of_static_ticks(spark):
    schema = "symbol string, ts timestamp, close double, ingest_id bigint"
    data = [
        ("A", at(0), 100.0, 1), ("A", at(1), 100.6, 2), ("A", at(2), 100.0, 3), ("A", at(2), 101.0, 4),
        ("B", at(0), 1.0, 5), ("Z", at(0), 0.0, 6), ("Z", at(1), 5.0, 7),
    ]
    for chunk in (1, 3600):
        got = S.velocities(spark.createDataFrame(data, schema), chunk)
        found = rows(got.select("symbol", "ts", F.round("velocity", 4)), "symbol", "ts", "price")
        assert found == [
            ("A", at(1), 0.6), ("A", at(2), -0.5964), ("A", at(2), None), ("Z", at(1), None),
        ]
        assert S.velocity_alerts(got).count() == 2
    assert column(S.late_ticks(spark.createDataFrame(data, schema), "1 second"), "ingest_id", "ingest_id") == [1, 5, 6]


@pytest.mark.parametrize("chunk", ["1 second", "5 seconds"])
def test_velocity_stream_orders_and_links_batches(spark, feed, chunk):
    feed.add(event("A", 0, 100.0, 1), event("A", 2, 102.0, 3), event("B", 0, 1.0, 2))
    feed.add(event("A", 1, 101.0, 4))  # out of order, within the delay
    feed.add(event("A", 20, 100.0, 5), event("B", 20, 2.0, 6)).add(event("C", 21, 1.0, 10))
    feed.add(event("A", 1.5, 7.0, 7))  # late: dropped
    feed.add(event("A", 40, 100.0, 8), event("D", 41, 1.0, 9))
    got = velocities_to_end(feed.ticks("10 seconds"), chunk)
    found = rows(got.select("symbol", "ts", "price", F.round("velocity", 6)), "symbol", "ts")
    assert found == [
        ("A", at(1), 101.0, 1.0),
        ("A", at(2), 102.0, round(100 / 101, 6)),
        ("A", at(20), 100.0, round(-2 / 102 * 100 / 18, 6)),
        ("B", at(20), 2.0, 5.0),
    ]


def test_velocity_takes_the_files_of_a_batch_together(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setattr("tickloom.streaming.velocity.ENDS_PER_TRIGGER", 1, raising=False)
    symbols = "ABCDEFGHIJKL"
    feed.add(*(event(s, 600 * k + i, 100.0 + k, 100 * i + k) for i, s in enumerate(symbols) for k in range(5))).add(event("Z", 100_000, 1.0, 5000))
    root = str(tmp_path / "velocity")
    for query in start_velocities(feed.ticks("10 seconds"), root):
        query.awaitTermination()
    assert len(list((tmp_path / "velocity" / "ends").glob("*.parquet"))) > 2
    got = rows(read_velocities(spark, root).select("symbol", "ts"), "symbol", "ts")
    assert got == [(s, at(600 * k + i)) for i, s in enumerate(symbols) for k in range(1, 5)]


def test_velocity_goes_on_where_it_stopped(spark, feed, tmp_path):
    root = str(tmp_path / "velocity")
    feed.add(event("A", 0, 100.0, 1)).add(event("B", 100, 1.0, 2))
    for query in start_velocities(feed.ticks("10 seconds"), root):
        query.awaitTermination()
    assert read_velocities(spark, root).count() == 0
    feed.add(event("A", 120, 103.0, 3)).add(event("B", 300, 1.0, 4))
    for query in start_velocities(feed.ticks("10 seconds"), root):
        query.awaitTermination()
    got = rows(read_velocities(spark, root).select("symbol", "ts", "velocity"))
    assert got == [("A", at(120), 3.0 / 120)]


def test_velocity_runs_continuously(spark, feed, tmp_path):
    root = str(tmp_path / "velocity")
    feed.add(event("A", 0, 100.0, 1), event("A", 1, 101.0, 2)).add(event("A", 120, 202.0, 3)).add(event("B", 300, 1.0, 4))
    queries = start_velocities(feed.ticks("10 seconds"), root, continuous=True)
    for query in queries:
        query.processAllAvailable()
    queries[-1].processAllAvailable()
    for query in queries:
        query.stop()
    got = rows(read_velocities(spark, root).select("ts", F.round("velocity", 6)), "ts")
    assert got == [(at(1), 1.0), (at(120), round(100 / 119, 6))]


def test_a_silent_symbol_is_forgotten(spark, feed):
    day = 86_400
    feed.add(event("A", 0, 1.0, 1), event("B", 0, 1.0, 2))
    feed.add(event("B", day + 60, 1.0, 3)).add(event("B", day + 120, 1.0, 4))
    feed.add(event("A", day + 121, 9.0, 5)).add(event("B", 2 * day, 1.0, 6))
    got = velocities_to_end(feed.ticks("10 seconds"))
    assert "A" not in column(got, "symbol", "ts")


def test_a_rerun_processes_new_files_only(spark, feed, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    feed.add(event("A", 0, 1.0, 1))
    sinks.append_to(feed.ticks(), out, progress).awaitTermination()
    feed.add(event("A", 1, 2.0, 2))
    sinks.append_to(feed.ticks(), out, progress).awaitTermination()
    assert column(spark.read.parquet(out), "close", "ts") == [1.0, 2.0]


def test_continuous_trigger(spark, feed, tmp_path):
    feed.add(event("A", 0, 1.0, 1))
    query = sinks.append_to(feed.ticks(), str(tmp_path / "out"), str(tmp_path / "progress"), continuous=True)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_late_ticks_are_kept_apart(spark, feed, tmp_path):
    from tickloom.streaming import late

    feed.add(event("A", 0, 1.0, 1), event("A", 100, 2.0, 2))
    feed.add(event("A", 80, 3.0, 3), event("A", 95, 4.0, 4), event("B", 200, 5.0, 5))
    feed.add(event("A", 150, 6.0, 6))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    parsed = feed.ticks()
    for _ in range(2):
        late.keep_late_apart(parsed, out, progress, "10 seconds", "60 seconds").awaitTermination()
    assert column(late.read_routed(spark, out, "late", parsed.schema), "ingest_id", "ingest_id") == [3, 6]
    assert column(late.read_routed(spark, out, "timely", parsed.schema), "ingest_id", "ingest_id") == [2, 5]
    assert late.read_routed(spark, str(tmp_path / "none"), "late", parsed.schema).count() == 0


def test_routed_events_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from tickloom.workload import queries

    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    days = [(i * 7) % 50 for i in range(40)]
    events = [event("A", 86_400.0 * d, 1.0, i + 1) for i, d in enumerate(days)]
    schema = S.read_events(spark, "json", path=str(tmp_path)).schema
    df = spark.createDataFrame([tuple(e.get(n) for n in schema.names) for e in events], schema).repartition(4)
    got = queries._routed(SimpleNamespace(spark=spark, tick_events=df), "late")
    expected, newest = [], None
    for batch in range(5):
        part = [(i + 1, d) for i, d in enumerate(days) if i // 2 % 5 == batch]
        expected += [i for i, d in part if newest is not None and d < newest - 20]
        newest = max([d for _, d in part] + ([newest] if newest is not None else []))
    assert expected and column(got, "ingest_id", "ingest_id") == sorted(expected)
    assert len(list((tmp_path / "feed").glob("*.parquet"))) > 5
    assert len(list((tmp_path / "routed" / "newest").glob("batch_id=*"))) == 5


def test_last_points_equal_a_plain_window_over_blocks_and_chunks(spark):
    import random

    from tickloom.operators.chunked import over_last_rows

    r = random.Random(3)
    data = [(f"S{r.choice([0, 0, 0, 1, 2])}", r.randrange(400), i, r.random()) for i in range(900)]
    df = spark.createDataFrame(data, "symbol string, at long, ingest_id long, price double").repartition(5)
    chunk = F.floor(F.col("at") / 7)
    for n, block in ((5, 12), (1, 10), (9, 4)):
        over = {"average": lambda w: F.avg("price").over(w), "ticks": lambda w: F.count("*").over(w)}
        got = over_last_rows(df, "symbol", ["at", "ingest_id"], chunk, n, over, block=block)
        frame = Window.partitionBy("symbol").orderBy("at", "ingest_id").rowsBetween(-(n - 1), 0)
        plain = df.withColumns({"average": F.avg("price").over(frame), "ticks": F.count("*").over(frame)})
        one, other = (sorted(tuple(x) for x in d.collect()) for d in (got, plain))
        assert [x[:4] + x[5:] for x in one] == [x[:4] + x[5:] for x in other]
        assert [x[4] for x in one] == pytest.approx([x[4] for x in other], rel=1e-12)


def plain_averages(events, points):
    """Average and number of the last points of each tick, by its symbol and second."""
    last = {}
    for symbol, second, price, number in events:
        if (symbol, second) not in last or number > last[symbol, second][1]:
            last[symbol, second] = (price, number)
    out = {}
    for symbol, second in last:
        before = sorted(s for x, s in last if x == symbol and s <= second)[-points:]
        out[symbol, second] = (pytest.approx(sum(last[symbol, s][0] for s in before) / len(before), rel=1e-12), len(before))
    return out


@pytest.mark.parametrize(("points", "block"), [(4, 5), (1, 100), (50, 8)])
def test_last_points_of_a_stream_out_of_order_and_over_restarts(spark, feed, tmp_path, points, block):
    import random

    from tickloom.streaming.points import read_last_points, start_last_points

    r = random.Random(points)
    events = [(r.choice("AAAB"), s, r.random(), s + 1) for s in range(120)]
    # Some are delivered again with another price, some out of order by less than the delay.
    events += [(x, s, price + 1, number + 1000) for x, s, price, number in events if number % 9 == 0]
    events.sort(key=lambda e: e[1] + r.uniform(0, 10))
    for part in range(4):
        for file in (0, 1):
            lot = events[part * 36 + file * 18 : part * 36 + (file + 1) * 18]
            feed.add(*[event(x, s, price, number) for x, s, price, number in lot])
        start_last_points(feed.ticks(), str(tmp_path / "out"), str(tmp_path / "progress"), points, "20 seconds", chunk_seconds=7, block=block).awaitTermination()
    seen = events[:144]
    newest = max(s for _, s, _, _ in seen)
    got = {(x["symbol"], (x["ts"].replace(tzinfo=None) - at(0)).total_seconds()): (x["average"], x["ticks"]) for x in read_last_points(spark, str(tmp_path / "out")).collect()}
    wanted = {k: v for k, v in plain_averages(seen, points).items() if k[1] < newest - 20}
    assert len(wanted) > 80 and got == wanted
    for kind in ("mark", "open", "tails"):
        assert len(list((tmp_path / "out" / kind).glob("batch_id=*"))) == 2


def test_last_points_of_a_batch_run_again_after_a_crash(spark, feed, tmp_path, monkeypatch):
    from tickloom.streaming import points as P

    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    run = lambda: P.start_last_points(feed.ticks(), out, progress, 3, "5 seconds", "1 hour").awaitTermination()
    feed.add(*[event("A", s, float(s), s + 1) for s in range(12)])
    run()
    write = P._write

    def broken(df, path):
        if "/tails/" in path:
            raise OSError("lost")
        write(df, path)

    feed.add(*[event("A", s, float(s), s + 1) for s in range(12, 30)], event("A", 2, 99.0, 500), event("B", 9000, 1.0, 501))
    monkeypatch.setattr(P, "_write", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(P, "_write", write)
    run()
    feed.add(event("A", 9001, 7.0, 502), event("C", 20000, 1.0, 503), event(None, 20000, 1.0, 504))
    run()
    got = {(x["symbol"], x["ingest_id"]): (x["average"], x["ticks"]) for x in P.read_last_points(spark, out).collect()}
    # The late tick is left out; what is more than an hour behind the mark is forgotten.
    wanted = {("A", s + 1): (sum(range(max(0, s - 2), s + 1)) / min(3, s + 1), min(3, s + 1)) for s in range(30)}
    assert got == wanted | {("B", 501): (1.0, 1), ("A", 502): (7.0, 1)}
    assert P.read_last_points(spark, str(tmp_path / "none")).collect() == []


def test_stored_sketches_count_any_longer_window(spark):
    data = [("S" + str((7 * k) % 900), START + dt.timedelta(seconds=17 * k), 1.0) for k in range(3000)] + [(None, START, 1.0)]
    df = spark.createDataFrame(data, "symbol string, ts timestamp, close double")
    panes = S.symbol_sketches(df, "1 minute")
    for window, seconds in (("1 minute", 60), ("10 minutes", 600), ("4 hours", 14400)):
        exact: dict = {}
        for symbol, ts, _ in data:
            if symbol:
                start = (ts - START).total_seconds() // seconds * seconds
                exact.setdefault(at(start), set()).add(symbol)
        got = {x["window_start"].replace(tzinfo=None): x["active_symbols"] for x in S.active_from_sketches(panes, window).collect()}
        assert set(got) == set(exact)
        assert all(abs(got[k] - len(v)) <= max(1, 0.08 * len(v)) for k, v in exact.items())


def test_flushed_groups_are_bounded_and_complete_over_restarts(spark, tmp_path):
    from tickloom.streaming import sinks

    feed, out, progress = (str(tmp_path / n) for n in ("feed", "out", "progress"))
    seen = 0
    for load in (950, 3, 0, 1200):
        spark.range(seen, seen + load).repartition(3).write.mode("append").parquet(feed)
        seen += load
        stream = spark.readStream.schema("id long").parquet(feed)
        sinks.flush_groups(stream, out, progress, most=100).awaitTermination()
    stored = spark.read.parquet(out)
    assert sorted(x[0] for x in stored.select("id").collect()) == list(range(seen))
    sizes = [x[0] for x in stored.groupBy("batch_id", "task", "part").agg(F.count("*")).select("count(1)").collect()]
    assert max(sizes) == 100 and len(sizes) < 2 * seen / 100 + 20


def test_message_rate_of_panes_equals_sliding_windows(spark):
    import random

    r = random.Random(5)
    data = [(r.choice("AAAB"), dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=r.randrange(400_000))) for _ in range(3000)] + [("C", None)]
    df = spark.createDataFrame(data, "symbol string, ts timestamp")
    # 25 seconds are not whole steps of 10: panes of 5 make both.
    for lookback, refresh, pane in (("60 seconds", "10 seconds", 10), ("25 seconds", "10 seconds", 5), ("7 seconds", "7 seconds", 7)):
        assert S.pane_width(spark, lookback, refresh) == f"{pane * 1_000_000} microseconds"
        plain = df.groupBy(F.window("ts", lookback, refresh).alias("w"), "symbol").agg(F.count("*").alias("n")).select("w.start", "w.end", "symbol", "n")
        got = S.message_rate(df, lookback, refresh)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_compacted_versions_read_as_before_and_stay_few(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "versions")
    schema = spark.createDataFrame([], "symbol string, v long, batch_number int").schema
    assert sinks.compact_versions(spark, path, schema, ["symbol"]) is None
    expected = {}

    def batches():
        return sorted(int(p.name.split("=")[1]) for p in (tmp_path / "versions").glob("batch_id=*"))

    def read():
        found = rows(sinks.newest_versions(spark, path, schema, ["symbol"]))
        assert len(found) == len({x[0] for x in found})
        return {x[0]: x[1:] for x in found}

    for n in range(12):
        load = [(f"s{(n * k) % 7}", 10 * n + k, n) for k in range(2)] + [(None, n, n)]
        load = list({x[0]: x for x in load}.values())
        spark.createDataFrame(load, schema).write.parquet(f"{path}/batch_id={n}")
        expected |= {x[0]: x[1:] for x in load}
        if n % 3 == 2:
            assert sinks.compact_versions(spark, path, schema, ["symbol"]) == n - 1
            assert sinks.compact_versions(spark, path, schema, ["symbol"]) == n - 1
        assert read() == expected
    assert batches() == [8, 9, 10, 11]
    assert sinks.snapshots(spark, path) == [7, 10]
    # A snapshot that was not finished does not count; the last batch may be run again.
    (tmp_path / "versions-snapshots" / "upto=10" / "_SUCCESS").unlink()
    assert sinks.snapshots(spark, path) == [7] and read() == expected
    assert sinks.compact_versions(spark, path, schema, ["symbol"]) == 10 and read() == expected
    # A crash before the removal leaves more files and the same answer.
    spark.createDataFrame([("new", 1, 12)], schema).write.parquet(f"{path}/batch_id=12")
    monkeypatch.setattr(sinks, "remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sinks.compact_versions(spark, path, schema, ["symbol"])
    monkeypatch.undo()
    assert read() == expected | {"new": (1, 12)}


def test_expired_hours_are_removed_and_no_other(spark, feed, tmp_path):
    from tickloom.streaming import late

    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    assert late.remove_expired(spark, out, "2 hours") == []
    hour = 3600
    feed.add(event("A", 10, 1.0, 1), event("A", hour + 5, 1.0, 2), event("B", 2 * hour, 1.0, 3))
    parsed = feed.ticks()
    late.keep_late_apart(parsed, out, progress, "10 hours", "2 hours").awaitTermination()
    assert late.remove_expired(spark, out, "2 hours") == []
    feed.add(event("A", 3 * hour + 30, 1.0, 4), event("A", hour + 40, 1.0, 5), event("A", hour + 20, 1.0, 6))
    for _ in range(2):
        late.keep_late_apart(parsed, out, progress, "10 hours", "2 hours").awaitTermination()
    removed = [late.remove_expired(spark, out, "2 hours") for _ in range(2)]
    assert removed == [["2024-01-01-00"], []]
    kept = late.read_routed(spark, out, "timely", parsed.schema)
    assert kept.columns == parsed.columns
    # Of the hour in which the retention begins all is kept that was stored.
    assert column(kept, "ingest_id", "ingest_id") == [2, 3, 4, 5]


def test_a_slow_source_loses_nothing_to_a_fast_one(spark, feed, tmp_path):
    from tickloom.streaming import late

    feed.add(event("fast", 1000, 1.0, 1), event("slow", 10, 1.0, 2))
    feed.add(event("fast", 2000, 1.0, 3), event("slow", 12, 1.0, 4), event("fast", 900, 1.0, 5))
    feed.add(event("slow", 1, 1.0, 6), event("slow", 9, 1.0, 7), event("other", 0, 1.0, 8), event("slow", 3, 1.0, 9, start_timestamp=None))
    parsed = feed.ticks()
    for source, late_ids in ((None, [4, 5, 6, 7, 8, 9]), ("symbol", [5, 6, 9])):
        out, progress = str(tmp_path / f"out-{source}"), str(tmp_path / f"progress-{source}")
        late.keep_late_apart(parsed, out, progress, "5 seconds", source=source).awaitTermination()
        assert column(late.read_routed(spark, out, "late", parsed.schema), "ingest_id", "ingest_id") == late_ids
        assert late.read_routed(spark, out, "timely", parsed.schema).count() == 9 - len(late_ids)


def test_symbols_are_forgotten_after_a_silence(spark, feed):
    ticks = lambda *of: [event(s, x, 1.0, i) for i, (s, x) in enumerate(of)]
    feed.add(*ticks(("A", 50), ("B", 0), ("A", 0), ("A", 20)))
    feed.add(*ticks(("A", 110), ("A", 171), (None, 5), ("B", 500)))
    feed.add(*ticks(("B", 520)))
    sessions = S.symbol_sessions(feed.ticks("0 seconds"), "1 minute")
    found = sinks.run_to_end(sessions, "sessions")
    found = found.select("symbol", *[(F.unix_millis(c) / 1000 - START.timestamp()).cast("int").alias(c) for c in ("first_seen", "last_seen")], "ticks")
    # A tick after exactly a minute goes on with the stretch, one after 61 seconds does not; the last stretch of B is open.
    assert sorted(rows(found)) == [("A", 0, 110, 4), ("A", 171, 171, 1), ("B", 0, 0, 1)]


def test_sessions_on_static_data(spark):
    df = spark.createDataFrame([("A", START), ("A", START + dt.timedelta(days=31)), (None, START), ("A", None)], "symbol string, ts timestamp")
    assert S.symbol_sessions(df, "30 days").count() == 2 and S.symbol_sessions(df.limit(0), "30 days").count() == 0
