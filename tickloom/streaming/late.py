"""Ticks that a watermarked stream no longer takes, kept apart and counted, and the removal of expired ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tickloom.session import Scratch, remove
from tickloom.sources.writers import path_exists, stored_values

_MARKS = T.StructType([T.StructField("source", T.StringType()), T.StructField("newest", T.TimestampType())])
#: Names of the folders that ticks with a retention are stored in; by name is by time.
_FOLDERS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def newest_before(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """Newest event time of each source in all batches before one, or in all: ``source``, ``newest``.

    Every batch stores what is known after it, so only the last one before is read.
    """
    numbers = [int(v) for v in stored_values(spark, f"{path}/newest", "batch_id")]
    before = [n for n in numbers if batch_id is None or n < batch_id]
    if not before:
        return spark.createDataFrame([], _MARKS)
    return spark.read.schema(_MARKS).parquet(f"{path}/newest/batch_id={max(before)}")


def _folder(time: Column, per: str) -> Column:
    return F.date_format(time, _FOLDERS[per])


def keep_late_apart(
    ticks: DataFrame, path: str, checkpoint: str, delay: str, retention: str | None = None, source: str | None = None, per: str = "hour"
) -> StreamingQuery:
    """Write the ticks of each batch that lie behind the watermark to ``late``, others to ``timely``.

    The watermark of a batch is the newest event time of the batches before it,
    less the delay; with a ``source`` column each source has its own, so a slow one loses nothing when
    a fast one runs ahead.  Each batch is stored once before it is routed, and leaves one row per source
    to know the next watermark by.  With a retention, ticks older than that (by the newest one of their source in the batch) are not
    stored as timely either, and timely ones lie in folders per hour or day, for ``remove_expired``.  Ticks without a time are late.  A batch run again overwrites its folders.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with Scratch(spark) as scratch:
            own = F.col(f"`{source}`").cast("string") if source else F.lit(None).cast("string")
            rows = scratch.keep(batch.select(F.struct("*").alias("tick"), own.alias("source"), F.col("ts").alias("time")), "batch")
            before = newest_before(spark, path, batch_id)
            own_newest = rows.groupBy("source").agg(F.max("time").alias("newest"))
            marks = before.unionByName(own_newest).where("newest IS NOT NULL")
            marks = marks.groupBy("source").agg(F.max("newest").alias("newest"))
            marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
            known = before.select(F.col("source").alias("of"), (F.col("newest") - F.expr(f"INTERVAL {delay}")).alias("bound"))
            judged = rows.join(known, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("is_late", F.col("time").isNull() | F.coalesce(F.col("time") < F.col("bound"), F.lit(False)))
            judged.where("is_late").select("tick.*").write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            timely = judged.where("NOT is_late")
            if not retention:
                timely.select("tick.*").write.mode("overwrite").parquet(f"{path}/timely/batch_id={batch_id}")
                return
            by_source = own_newest.select(F.col("source").alias("whose"), (F.col("newest") - F.expr(f"INTERVAL {retention}")).alias("oldest"))
            timely = timely.join(by_source, F.col("source").eqNullSafe(F.col("whose"))).where(F.col("time") >= F.col("oldest"))
            stored = timely.select("tick.*", _folder(F.col("time"), per).alias("stored_at"), F.lit(batch_id).cast("long").alias("stored_batch"))
            writer = stored.hint("rebalance", F.col("stored_at")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("stored_at", "stored_batch").parquet(f"{path}/timely")

    return ticks.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def expiry(spark: SparkSession, path: str, retention: str, per: str = "hour") -> str | None:
    """The first folder that is kept: that of the newest time of the slowest source, less the retention."""
    bound = F.min("newest") - F.expr(f"INTERVAL {retention}")
    return newest_before(spark, path).select(_folder(bound, per)).first()[0]


def remove_expired(spark: SparkSession, path: str, retention: str, per: str = "hour") -> list[str]:
    """Remove the timely ticks of hours or days that lie before the retention as a whole; returns these.

    Folders are removed and no row is read.  A run that was cut off is finished by the next one.
    """
    first = expiry(spark, path, retention, per)
    expired = sorted(v for v in stored_values(spark, f"{path}/timely", "stored_at") if first is not None and v < first)
    for value in expired:
        remove(spark, f"{path}/timely/stored_at={value}")
    return expired


def read_routed(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    """What ``keep_late_apart`` stored as late or timely."""
    if not path_exists(spark, f"{path}/{kind}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{kind}").select(*[F.col(f"`{n}`") for n in schema.names])
