"""Velocity on a stream: consecutive ticks of a symbol, in event-time order.

Ticks are gathered per symbol and short chunk of time, so a symbol with a
third of all ticks is many small groups.  Inside a chunk neighbours are paired
by array functions.  The first and the last tick of each chunk, one row
however many ticks it had, are written to a table of their own; a second
stream reads it and links every chunk with the one before it, in a state that
holds one tick per symbol and forgets symbols that fell silent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom import constants as K
from tickloom.functions.columns import nonzero
from tickloom.session import scratch_path
from tickloom.sources.writers import make_folder
from tickloom.streaming.sinks import append_to
from tickloom.streaming.ticks import keep_last, velocity_alerts

# Length of a chunk: a symbol has at most one aggregate per second.
CHUNK = "1 minute"
OUTPUT = "symbol string, ts timestamp, price double, velocity double"
_PAIR = "symbol string, ms bigint, price double, prev_ms bigint, prev_price double"
_STATE = "ms bigint, price double"


def _link(retention_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def link(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Pair the first tick of every chunk with the last one before it.

        The watermark closes chunks in order, so all that arrives lies behind
        what the state knows.  A symbol silent for longer than the retention is
        forgotten: its next tick has no predecessor anyway.
        """
        if state.hasTimedOut:
            state.remove()
            return
        ends = pd.concat(list(batches)).sort_values("first_ms", ignore_index=True)
        before = ends[["last_ms", "last_price"]].shift()
        if state.exists:
            before.iloc[0] = state.get
        pairs = pd.DataFrame(
            {
                "symbol": key[0],
                "ms": ends["first_ms"],
                "price": ends["first_price"],
                "prev_ms": before["last_ms"],
                "prev_price": before["last_price"],
            }
        ).dropna(subset=["prev_ms"])
        newest = int(ends["last_ms"].iloc[-1])
        state.update((newest, float(ends["last_price"].iloc[-1])))
        state.setTimeoutTimestamp(max(newest + retention_ms, state.getCurrentWatermarkMs()) + 1)
        if len(pairs):
            yield pairs.astype({"prev_ms": "int64"})

    return link


def _tick() -> Column:
    return F.struct(F.unix_millis("ts").alias("ms"), "ingest_id", F.col("close").alias("price"))


def pairs_in_chunks(ticks: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """Neighbouring ticks of a symbol within a chunk, once the watermark has passed its end.

    Needs symbol, ts, close and ingest_id.
    """
    def pair(now: Column, before: Column) -> Column:
        return F.struct(
            now["ms"].alias("ms"), now["price"].alias("price"),
            before["ms"].alias("prev_ms"), before["price"].alias("prev_price"),
        )

    gathered = ticks.groupBy(F.window("ts", chunk), "symbol").agg(F.array_sort(F.collect_list(_tick())).alias("ticks"))
    size = F.size("ticks")
    neighbours = F.zip_with(F.slice("ticks", 2, size), F.slice("ticks", 1, size - 1), pair)
    return gathered.select("symbol", F.inline(neighbours))


def chunk_ends(ticks: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """First and last tick of every symbol and chunk."""
    ends = ticks.groupBy(F.window("ts", chunk), "symbol").agg(F.min(_tick()).alias("first"), F.max(_tick()).alias("last"))
    return ends.select(
        "symbol",
        F.col("first.ms").alias("first_ms"),
        F.col("first.price").alias("first_price"),
        F.col("last.ms").alias("last_ms"),
        F.col("last.price").alias("last_price"),
    )


def link_chunks(ends: DataFrame, chunk: str = CHUNK, retention: str = K.VELOCITY_RETENTION) -> DataFrame:
    """Pairs over the borders of chunks, from a stream over stored chunk ends.

    Chunks are stored once their end has passed, so ends of later batches lie
    at most a chunk behind earlier ones.  That holds for whole stored batches
    only: within one, every file has other symbols and all times.
    """
    timed = ends.withColumn("last_time", F.timestamp_millis("last_ms")).withWatermark("last_time", chunk)
    forget = int(pd.Timedelta(retention).total_seconds() * 1000)
    return timed.groupBy("symbol").applyInPandasWithState(
        _link(forget), _PAIR, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def pair_velocities(pairs: DataFrame, retention: str = K.VELOCITY_RETENTION) -> DataFrame:
    """Percent per second of every pair.

    Two ticks at the same time have no velocity; a tick after a silence longer
    than the retention has no predecessor.
    """
    kept = F.timestamp_millis("ms") - F.timestamp_millis("prev_ms") <= F.expr(f"INTERVAL {retention}")
    change = (F.col("price") - F.col("prev_price")) / nonzero(F.col("prev_price")) * 100
    seconds = (F.col("ms") - F.col("prev_ms")) / 1000
    return pairs.where(kept).select(
        "symbol", F.timestamp_millis("ms").alias("ts"), "price", (change / nonzero(seconds)).alias("velocity")
    )


def start_velocities(
    ticks: DataFrame, root: str, chunk: str = CHUNK, continuous: bool = False, alerts_only: bool = False
) -> list[StreamingQuery]:
    """Write the velocities of a watermarked stream below ``root``, or only those that call for an alert.

    ``root`` also keeps the chunk ends and the progress of the three streams,
    so all of them go on where they stopped.  ``read_velocities`` reads the
    result.  Unless ``continuous``, what is available is processed, the chunk
    ends before their links.
    """
    spark = ticks.sparkSession
    make_folder(spark, f"{root}/ends")
    # Of ticks delivered again the last one counts.
    ticks = keep_last(ticks)
    ends = chunk_ends(ticks, chunk)
    chosen = velocity_alerts if alerts_only else lambda velocities: velocities
    inside = chosen(pair_velocities(pairs_in_chunks(ticks, chunk)))
    first = [
        append_to(inside, f"{root}/inside", f"{root}/progress/inside", continuous),
        append_to(ends, f"{root}/ends", f"{root}/progress/ends", continuous),
    ]
    if not continuous:
        for query in first:
            query.awaitTermination()
    # No limit of files: the sink's log shows a batch's files together, and they must be taken together.
    stored = spark.readStream.schema(ends.schema).parquet(f"{root}/ends")
    linked = chosen(pair_velocities(link_chunks(stored, chunk)))
    links = append_to(linked, f"{root}/links", f"{root}/progress/links", continuous)
    return [*first, links]


def read_velocities(spark: SparkSession, root: str) -> DataFrame:
    parts = [spark.read.schema(OUTPUT).parquet(f"{root}/{name}") for name in ("inside", "links")]
    return parts[0].unionByName(parts[1])


def velocities_to_end(ticks: DataFrame, chunk: str = CHUNK, alerts_only: bool = False) -> DataFrame:
    """Velocities of everything available, kept in the shared folder."""
    root = scratch_path(ticks.sparkSession, "velocity")
    for query in start_velocities(ticks, root, chunk, alerts_only=alerts_only):
        query.awaitTermination()
    return read_velocities(ticks.sparkSession, root)
