"""Averages over the last points of each symbol, followed on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tickloom.operators.chunked import over_last_rows
from tickloom.session import Scratch, remove
from tickloom.sources.writers import path_exists, stored_values
from tickloom.streaming.ticks import keep_last

_POINT = "symbol string, ts timestamp, ingest_id bigint, price double"
_ORDER = ["ts", "ingest_id"]


def _done(spark: SparkSession, path: str) -> list[int]:
    """Batches whose state is written whole, in order; the mark is written last."""
    found = sorted(int(v) for v in stored_values(spark, f"{path}/mark", "batch_id"))
    return [n for n in found if path_exists(spark, f"{path}/mark/batch_id={n}/_SUCCESS")]


def _state(spark: SparkSession, path: str, kind: str, schema: str, batch: int | None) -> DataFrame:
    if batch is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{kind}/batch_id={batch}")


def start_last_points(
    ticks: DataFrame, path: str, checkpoint: str, points: int, delay: str, retention: str | None = None, chunk_seconds: int = 3600, block: int = 100_000
) -> StreamingQuery:
    """Average price of each tick and the ``points - 1`` before it of its symbol, as stored by ``read_last_points``.

    Ticks are held open until the newest event time, less the delay, has passed them; then they are in order whatever
    the order they came in, and of those delivered again the last one counts.  What is behind that mark when it comes is
    late and left out, as are ticks without time or symbol.  Three things are handed from batch to batch: the mark, the open ticks, and
    each symbol's last ``points - 1`` released ones, which with a retention are forgotten after a batch that left them that far behind the mark.
    A symbol is spread over chunks of time and blocks of rows, however large its share.  A batch that is run again begins from the state
    before it and overwrites its folders, so no average is lost or given twice.
    """

    def release(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [n for n in _done(spark, path) if n < batch_id]
        last = before[-1] if before else None
        with Scratch(spark) as scratch:
            came = batch.select("symbol", "ts", "ingest_id", F.col("close").cast("double").alias("price"))
            came = scratch.keep(came.where("symbol IS NOT NULL AND ts IS NOT NULL"), "points")
            old = _state(spark, path, "mark", "newest timestamp", last)
            newest = old.unionByName(came.select(F.col("ts").alias("newest"))).agg(F.max("newest").alias("newest"))
            newest = scratch.keep(newest, "newest")
            late = old.select(F.max("newest")).scalar() - F.expr(f"INTERVAL {delay}")
            mark = newest.select("newest").scalar() - F.expr(f"INTERVAL {delay}")
            timely = came.where(F.coalesce(F.col("ts") >= late, F.lit(True)))
            held = keep_last(_state(spark, path, "open", _POINT, last).unionByName(timely))
            held = scratch.keep(held.withColumn("closed", F.coalesce(F.col("ts") < mark, F.lit(False))), "held")
            _write(held.where("NOT closed").drop("closed"), f"{path}/open/batch_id={batch_id}")

            tails = _state(spark, path, "tails", _POINT, last)
            row = tails.withColumn("fresh", F.lit(False)).unionByName(held.where("closed").drop("closed").withColumn("fresh", F.lit(True)))
            chunk = F.floor(F.unix_millis("ts") / (chunk_seconds * 1000))
            over = {"average": lambda w: F.avg("price").over(w), "ticks": lambda w: F.count("*").over(w)}
            averages = over_last_rows(row, "symbol", _ORDER, chunk, points, over, block)
            _write(averages.where("fresh").drop("fresh"), f"{path}/averages/batch_id={batch_id}")
            # A limited row number is reduced in the map tasks.
            place = F.row_number().over(W.partitionBy("symbol").orderBy(*[F.desc(c) for c in _ORDER]))
            kept = row.withColumn("place", place).where(F.col("place") < points).drop("place", "fresh")
            if retention:
                # Only now, as the ticks released above may come right after them.
                kept = kept.where(F.coalesce(F.col("ts") >= mark - F.expr(f"INTERVAL {retention}"), F.lit(True)))
            _write(kept, f"{path}/tails/batch_id={batch_id}")
            _write(newest, f"{path}/mark/batch_id={batch_id}")
        # The state before this batch stays, as the batch may be run again.
        for n in before[:-1]:
            for kind in ("mark", "open", "tails"):
                remove(spark, f"{path}/{kind}/batch_id={n}")

    return ticks.writeStream.foreachBatch(release).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_last_points(spark: SparkSession, path: str) -> DataFrame:
    """All averages given so far: ``symbol``, ``ts``, ``ingest_id``, ``price``, ``average``, ``ticks``."""
    schema = T._parse_datatype_string(f"{_POINT}, average double, ticks bigint")
    if not path_exists(spark, f"{path}/averages"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/averages").select(*schema.names)
