"""Operators on tick streams.

All but the velocity run unchanged on static and on streaming DataFrames.
Column ``ts`` is the event time; ``ingest_id`` grows as events come in.
"""

from __future__ import annotations

from decimal import Decimal
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom import schemas
from tickloom.functions.columns import nonzero
from tickloom.operators.chunked import over_last_rows, previous_row

METRICS = ("open", "high", "low", "close", "volume", "vwap")

#: 4096 registers: a standard error of 1.6 %.
SKETCH_PRECISION = 12


def read_events(spark: SparkSession, fmt: str, schema=schemas.TICK_EVENT, **options: str) -> DataFrame:
    """Stream of wire events from files, or from a log such as Kafka.

    A log delivers JSON text in ``value``; files are read with the schema.
    Rate limits (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) pass through.
    """
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")
    return spark.readStream.schema(schema).format(fmt).options(**options).load()


def parse_ticks(events: DataFrame) -> DataFrame:
    """Keep second aggregates, turn milliseconds into event time, drop zero vwap."""
    return events.where(F.col("event_type") == "A").select(
        "symbol",
        F.timestamp_millis("start_timestamp").alias("ts"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        nonzero(F.col("vwap")).alias("vwap"),
        "ingest_id",
    )


def series(ticks: DataFrame) -> DataFrame:
    """One row per symbol, time and metric; a metric without a value has none."""
    long = ticks.unpivot(["symbol", "ts"], list(METRICS), "metric", "value")
    return long.where(F.col("value").isNotNull())


def arrival_order(ts: str = "ts", ingest_id: str = "ingest_id") -> Column:
    """Event time, then arrival, as one number.

    Minima and maxima by a number are kept in a hash table; by a struct Spark
    would have to sort all rows first.
    """
    return (
        F.unix_micros(ts).cast("decimal(18,0)") * F.lit(Decimal(10**19)) + F.col(ingest_id).cast("decimal(19,0)")
    ).cast("decimal(38,0)")


def latest_values(ticks: DataFrame) -> DataFrame:
    """Newest price of every symbol; of two at the same time the later arrival."""
    return ticks.groupBy("symbol").agg(
        F.max_by("close", arrival_order()).alias("price"), F.max("ts").alias("ts")
    )


def symbols(ticks: DataFrame) -> DataFrame:
    return ticks.select("symbol").dropDuplicates(["symbol"])


def symbol_sessions(ticks: DataFrame, silence: str) -> DataFrame:
    """Stretches in which a symbol was active: ``symbol``, ``first_seen``, ``last_seen``, ``ticks``.

    A stretch ends once the symbol was silent for longer than ``silence``; a symbol that comes back is announced anew.  On a
    stream with a watermark a stretch is given out, and its state dropped, when the mark has passed that silence, so the state holds the symbols
    that were active lately and no others.  Ticks of one symbol are merged within the map tasks, so a hot one is
    a few rows by the time it is shuffled.  Ticks without symbol or time belong to no stretch.
    """
    ticks.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    # Sessions meet only if they overlap or touch, so a tick after exactly the silence goes on with the stretch.
    known = ticks.where("symbol IS NOT NULL AND ts IS NOT NULL")
    return known.groupBy(F.session_window("ts", silence).alias("s"), "symbol").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("ticks")
    ).select("symbol", "first_seen", "last_seen", "ticks")


def update_messages(ticks: DataFrame) -> DataFrame:
    """Channel and JSON message for subscribers, one per tick."""
    message = F.struct(
        "symbol",
        F.col("close").alias("price"),
        F.unix_millis("ts").alias("timestamp"),
        "open",
        "high",
        "low",
        "volume",
        F.coalesce("vwap", F.lit(0.0)).alias("vwap"),
    )
    return ticks.select(F.concat(F.lit("updates:"), "symbol").alias("channel"), F.to_json(message).alias("message"))


def active_symbols(ticks: DataFrame, window: str = K.RATE_LOOKBACK, relative_error: float = 0.01) -> DataFrame:
    """Approximate number of symbols per window; needs no state per symbol."""
    return ticks.groupBy(F.window("ts", window).alias("w")).agg(
        F.approx_count_distinct("symbol", relative_error).alias("active_symbols")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "active_symbols")


def active_symbols_exact(ticks: DataFrame, window: str = K.RATE_LOOKBACK) -> DataFrame:
    """Exact number of symbols per window, counted in two stages.

    On a stream this needs two chained aggregations, which append mode with a
    watermark allows.
    """
    per_symbol = ticks.groupBy(F.window("ts", window).alias("w"), "symbol").agg(F.count("*").alias("n"))
    counted = per_symbol.groupBy(F.window(F.window_time("w"), window).alias("w2")).agg(
        F.count("*").alias("active_symbols")
    )
    return counted.select(F.col("w2.start").alias("window_start"), F.col("w2.end").alias("window_end"), "active_symbols")


def symbol_sketches(ticks: DataFrame, pane: str = "1 minute", precision: int = SKETCH_PRECISION) -> DataFrame:
    """A mergeable sketch of the symbols of each pane of time: ``window_start``, ``sketch``.

    Small however many symbols there are, so panes can be stored for good; ``active_from_sketches`` counts any longer stretch from
    them without looking at ticks again.  Ticks without a symbol count nothing.
    """
    return ticks.groupBy(F.window("ts", pane).alias("w")).agg(F.hll_sketch_agg("symbol", precision).alias("sketch")).select(
        F.col("w.start").alias("window_start"), "sketch"
    )


def active_from_sketches(sketches: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Approximate number of symbols per window from stored sketches of panes that windows are made of.

    The standard error is 1.04 over the root of 2 to the sketches' precision, whatever the window's length.
    """
    return sketches.groupBy(F.window("window_start", window, slide or window).alias("w")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active_symbols")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "active_symbols")


def pane_width(spark: SparkSession, lookback: str, refresh: str) -> str:
    """The widest pane that windows of this length and step are made of."""
    both = spark.sql(f"SELECT INTERVAL {lookback} AS a, INTERVAL {refresh} AS b").first()
    micros = [round(x.total_seconds() * 1_000_000) for x in both]
    return f"{gcd(*micros)} microseconds"


def message_rate(ticks: DataFrame, lookback: str = K.RATE_LOOKBACK, refresh: str = K.RATE_REFRESH) -> DataFrame:
    """Events per symbol in a trailing window that moves on every refresh.

    Events are counted once, in panes that every window is made of; windows sum up panes, so an event is never
    copied.  On a stream this chains two aggregations, which append mode with a watermark allows; an event whose
    pane is closed already is late.
    """
    panes = ticks.groupBy(F.window("ts", pane_width(ticks.sparkSession, lookback, refresh)).alias("pane"), "symbol").agg(F.count("*").alias("n"))
    return panes.groupBy(F.window(F.window_time("pane"), lookback, refresh).alias("w"), "symbol").agg(
        F.sum("n").alias("messages")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol", "messages")


def keep_last(ticks: DataFrame) -> DataFrame:
    """One tick per symbol and time, the one that arrived last.

    The result keeps the event time, so on a stream with a watermark the state
    is dropped once a time can no longer change.
    """
    rest = [c for c in ticks.columns if c not in ("symbol", "ts", "ingest_id")]
    last = [F.max_by(c, "ingest_id").alias(c) for c in rest]
    return ticks.groupBy("symbol", "ts").agg(F.max("ingest_id").alias("ingest_id"), *last).select(*ticks.columns)


def drop_exact_repeats(ticks: DataFrame) -> DataFrame:
    """Drop events that were delivered again unchanged, within the watermark."""
    keys = [c for c in ticks.columns if c != "ingest_id"]
    return ticks.dropDuplicatesWithinWatermark(keys) if ticks.isStreaming else ticks.dropDuplicates(keys)


def tick_candles(ticks: DataFrame, width: str) -> DataFrame:
    """Open, high, low, close and volume per symbol and tumbling window."""
    at = arrival_order()
    return ticks.groupBy(F.window("ts", width).alias("w"), "symbol").agg(
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at).alias("close"),
        F.sum("volume").alias("volume"),
    ).select(F.col("w.start").alias("window_start"), "symbol", "open", "high", "low", "close", "volume")


def tick_moving_average(ticks: DataFrame, lookback: str, refresh: str) -> DataFrame:
    """Average price per symbol over a sliding time window."""
    return ticks.groupBy(F.window("ts", lookback, refresh).alias("w"), "symbol").agg(
        F.avg("close").alias("average"), F.count("*").alias("ticks")
    ).select(F.col("w.end").alias("window_end"), "symbol", "average", "ticks")


def last_points_average(ticks: DataFrame, points: int, chunk_seconds: int = 3600) -> DataFrame:
    """Average price of each tick and the ``points - 1`` before it of its symbol, on static data.

    The order is by time, then arrival, however the ticks came; repeated deliveries are to be dropped before.
    """
    chunk = F.floor(F.unix_millis("ts") / (chunk_seconds * 1000))
    prices = ticks.select("symbol", "ts", "ingest_id", F.col("close").alias("price"))
    over = {"average": lambda w: F.avg("price").over(w), "ticks": lambda w: F.count("*").over(w)}
    return over_last_rows(prices, "symbol", ["ts", "ingest_id"], chunk, points, over)


def velocities(
    ticks: DataFrame, chunk_seconds: int = 3600, retention: str = K.VELOCITY_RETENTION
) -> DataFrame:
    """Percent per second between consecutive ticks of a symbol, on static data.

    A symbol is cut into chunks of time, so one with a third of all ticks is
    spread over many tasks.  Two ticks at the same time have no velocity, and
    a tick after a silence longer than the retention has no predecessor.
    """
    chunk = F.floor(F.unix_millis("ts") / (chunk_seconds * 1000))
    points = ticks.select("symbol", "ts", "ingest_id", F.col("close").alias("price"))
    linked = previous_row(points, "symbol", ["ts", "ingest_id"], ["ts", "price"], chunk)
    seconds = (F.unix_millis("ts") - F.unix_millis("prev_ts")) / 1000
    change = (F.col("price") - F.col("prev_price")) / nonzero(F.col("prev_price")) * 100
    kept = F.col("ts") - F.col("prev_ts") <= F.expr(f"INTERVAL {retention}")
    return linked.where(kept).select(
        "symbol", "ts", "price", (change / nonzero(seconds)).alias("velocity")
    )


def velocity_alerts(velocity: DataFrame, threshold: float = K.VELOCITY_ALERT_PERCENT) -> DataFrame:
    return velocity.where(F.abs("velocity") > threshold)


def late_ticks(ticks: DataFrame, delay: str) -> DataFrame:
    """Ticks that lie further than the delay behind the newest tick, on static data.

    These are what a stream that saw the newest tick in an earlier batch drops.
    """
    newest = ticks.select(F.max("ts")).scalar()
    return ticks.where(F.col("ts") < newest - F.expr(f"INTERVAL {delay}"))
