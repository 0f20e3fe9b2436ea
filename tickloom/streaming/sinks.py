"""Running streams and keeping their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tickloom import constants as K
from tickloom.session import remove, scratch_path
from tickloom.sources.writers import path_exists, stored_values

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, outside the heap, for many symbols."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def append_to(df: DataFrame, path: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Append finished rows as files; by default process what is there and stop."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": K.FLUSH_INTERVAL} if continuous else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start()


def upsert_batches(
    df: DataFrame, path: str, checkpoint: str, mode: str = "update", continuous: bool = False
) -> StreamingQuery:
    """Store every batch of changed rows in a folder of its own.

    A batch that is run again after a failure overwrites its folder, so the
    result stays right.  ``newest_versions`` reads the current state.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"processingTime": K.FLUSH_INTERVAL} if continuous else {"availableNow": True}
    return (
        df.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**trigger)
        .start()
    )


def flush_groups(df: DataFrame, path: str, checkpoint: str, most: int = K.FLUSH_EVENTS, continuous: bool = False) -> StreamingQuery:
    """Release events in groups of at most ``most``, and after the flush interval at the latest.

    The trigger ends the wait; what a trigger finds is numbered within its tasks, without a shuffle, and every ``most`` rows are a group,
    ``(batch_id, task, part)``.  A batch that is run again after a failure overwrites its groups, so no event is lost or released twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # The number of a row within its task is in the lower 33 bits.
        place = F.monotonically_increasing_id()
        grouped = batch.withColumn("_place", place).select(
            *batch.columns, F.shiftright("_place", 33).cast("int").alias("task"), F.floor(F.col("_place").bitwiseAND((1 << 33) - 1) / most).alias("part")
        )
        grouped.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"processingTime": K.FLUSH_INTERVAL} if continuous else {"availableNow": True}
    return df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The batches up to which finished snapshots of a folder of versions go, in order."""
    found = [int(v) for v in stored_values(spark, f"{path}-snapshots", "upto")]
    return sorted(n for n in found if path_exists(spark, f"{path}-snapshots/upto={n}/_SUCCESS"))


def stored_versions(spark: SparkSession, path: str, schema) -> DataFrame:
    """All versions that count: the newest snapshot and the batches after it, with ``batch_id``."""
    versioned = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not path_exists(spark, path):
        # The stream had nothing to read yet.
        return spark.createDataFrame([], versioned)
    stored = spark.read.schema(versioned).parquet(path)
    done = snapshots(spark, path)
    if not done:
        return stored
    snapshot = spark.read.schema(versioned).parquet(f"{path}-snapshots/upto={done[-1]}")
    return stored.where(F.col("batch_id") > done[-1]).unionByName(snapshot)


def last_versions(versions: DataFrame, keys: list[str]) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in versions.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*rest, F.col("batch_id")), "batch_id")
    return versions.groupBy(*keys).agg(newest.alias("v")).select(*[c if c in keys else F.col(f"v.`{c}`").alias(c) for c in versions.columns])


def newest_versions(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """The last stored version of every key."""
    return last_versions(stored_versions(spark, path, schema), keys).drop("batch_id")


def compact_versions(spark: SparkSession, path: str, schema, keys: list[str], spare: int = 1) -> int | None:
    """Fold all batches but the last ``spare`` into a snapshot, one row per key; returns the batch up to which it goes.

    A batch that may be run again is not folded.  A snapshot counts once it is written whole, so a crash at any point
    leaves the same answer, and a run after it goes on.  What the snapshot before covers is removed then, and no more:
    readers that began before this one still find their files, and two snapshots and the batches after the older one are all that is stored.
    """
    done = snapshots(spark, path)
    batches = sorted(int(v) for v in stored_values(spark, path, "batch_id"))
    fold = batches[: len(batches) - spare]
    if not fold or (done and fold[-1] <= done[-1]):
        return done[-1] if done else None
    rows = last_versions(stored_versions(spark, path, schema).where(F.col("batch_id") <= fold[-1]), keys)
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}-snapshots/upto={fold[-1]}")
    for n in done[:-1]:
        remove(spark, f"{path}-snapshots/upto={n}")
    for b in batches:
        if done and b <= done[-1]:
            remove(spark, f"{path}/batch_id={b}")
    return fold[-1]


def run_to_end(df: DataFrame, name: str, keys: list[str] | None = None) -> DataFrame:
    """Process all available data into the shared folder and read it back.

    With ``keys`` rows are updated as they change, else appended once final.
    """
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-progress")
    query = append_to(df, path, checkpoint) if keys is None else upsert_batches(df, path, checkpoint)
    query.awaitTermination()
    if keys is None:
        return spark.read.schema(df.schema).parquet(path)
    return newest_versions(spark, path, df.schema, keys)
