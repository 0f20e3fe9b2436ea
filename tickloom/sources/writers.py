"""Sinks: clustered, idempotent and incremental writes."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.constants import EPOCH_OF_HISTORY
from tickloom.session import Scratch, move, remove


#: Folders of the loads of a table that is appended to.
LOADED_UPTO = "loaded_upto"


def _status(spark: SparkSession, path: str, question: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return getattr(files, question)(location)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path, "exists")


def is_folder(spark: SparkSession, path: str) -> bool:
    return _status(spark, path, "isDirectory")


def make_folder(spark: SparkSession, path: str) -> None:
    _status(spark, path, "mkdirs")


def write_clustered(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Write with rows of equal cluster columns close together.

    ``mode`` is overwrite, append or fail.  The rebalance hint gathers rows by
    cluster columns and lets adaptive execution split what is too large for a
    task, so a dominant ticker becomes several files instead of one.
    """
    if mode not in ("overwrite", "append", "fail"):
        raise ValueError(f"unknown write mode {mode!r}")
    missing = [c for c in [*cluster_by, *partition_by] if c not in df.columns]
    if missing:
        raise ValueError(f"columns to cluster by are missing: {missing}")
    if mode == "fail" and path_exists(df.sparkSession, path):
        raise FileExistsError(f"{path} already exists")
    if cluster_by:
        df = df.hint("rebalance", *[F.col(c) for c in cluster_by]).sortWithinPartitions(*cluster_by)
    writer = df.write.mode("errorifexists" if mode == "fail" else mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str = "date") -> None:
    """Replace exactly the days that occur in ``df``; running it twice changes nothing.

    Only the folders of these days are touched.  The rows are rebalanced so a
    day is written by as many tasks as its size needs.
    """
    (
        df.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def replace_if_nonempty(df: DataFrame, path: str) -> bool:
    """Replace a table, but keep the old one when there is nothing to load.

    The load is written once, beside the table, and takes its place when it is whole; so ``df`` may read the table
    itself.  A run that failed in between is made good by the next one: the old table is
    put back, or what is left of either is removed.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    incoming, previous = f"{path}-incoming", f"{path}-previous"
    if path_exists(spark, previous):
        if path_exists(spark, path):
            remove(spark, previous)
        else:
            move(spark, previous, path)
    df.write.mode("overwrite").parquet(incoming)
    if spark.read.schema(df.schema).parquet(incoming).isEmpty():
        remove(spark, incoming)
        return False
    if path_exists(spark, path):
        move(spark, path, previous)
    move(spark, incoming, path)
    remove(spark, previous)
    return True


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows, with those of the same key replaced by the updates."""
    return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)


def last_records(updates: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the largest order value; of equal ones the largest row."""
    rest = [c for c in updates.columns if c not in keys]
    newest = F.max(F.struct(F.col(order).alias("order of arrival"), *rest)).alias("newest")
    return updates.groupBy(*keys).agg(newest).select(*[c if c in keys else F.col(f"newest.`{c}`").alias(c) for c in updates.columns])


def upsert(updates: DataFrame, path: str, keys: Sequence[str], partition_by: str, order: str | None = None) -> None:
    """Insert or replace rows by key in a table partitioned by one of the keys.

    Of several updates of a key the one with the largest ``order`` wins, as if
    they had come one by one; without an order a repeated key is an error.  Only
    the partitions that the updates fall into are read and written: their values are those of
    one load's days, so they stand in the plan as literals.  The new content is
    staged first, so nothing is read from where it is written.
    """
    if partition_by not in keys:
        raise ValueError("the partition column must be one of the keys")
    spark = updates.sparkSession
    with Scratch(spark) as scratch:
        # The updates are evaluated once, in the staged copy.
        incoming = scratch.keep(last_records(updates, keys, order) if order else updates, "updates")
        if not order and not incoming.groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError("keys repeat in the updates; name the column that orders them")
        if path_exists(spark, path):
            days = [r[0] for r in incoming.select(partition_by).distinct().collect()]
            touched = touched_partitions(spark.read.schema(incoming.schema).parquet(path), partition_by, days)
            incoming = scratch.keep(merge_rows(touched, incoming, keys), "merged")
        replace_partitions(incoming, path, partition_by)


def touched_partitions(stored: DataFrame, partition_by: str, values: Sequence[object]) -> DataFrame:
    """The rows of the given partitions; others are not listed for the scan."""
    known = [v for v in values if v is not None]
    found = F.col(partition_by).isin(known) if known else F.lit(False)
    return stored.where(found | F.col(partition_by).isNull() if len(known) < len(values) else found)


def newer_than(source: DataFrame, target: DataFrame | None, column: str = "date") -> DataFrame:
    """Source rows after the newest one of the target, or all if it has none."""
    start: Column = F.to_date(F.lit(EPOCH_OF_HISTORY))
    if target is not None:
        start = F.coalesce(target.select(F.max(column)).scalar(), start)
    return source.where(F.col(column) > start)


def stored_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column, from the names of the folders, in order of the names."""
    if not is_folder(spark, path):
        return []
    names = [s.getPath().getName() for s in _status(spark, path, "listStatus")]
    values = [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def newest_stored(spark: SparkSession, path: str, like: DataFrame, column: str = "date") -> DataFrame | None:
    """Values among which is a stored table's newest of the column; None where nothing is stored.

    Of a table that ``incremental_append`` stored they are the names of its loads' folders, and no row is read.
    """
    if not path_exists(spark, path):
        return None
    values = stored_values(spark, path, LOADED_UPTO)
    if values:
        return spark.createDataFrame([(v,) for v in values], "value string").select(F.col("value").cast(like.schema[column].dataType).alias(column))
    return spark.read.schema(like.schema).parquet(path).select(column)


def incremental_append(source: DataFrame, path: str, column: str = "date") -> None:
    """Append what is newer than anything stored, as a folder named by the newest value of the load.

    So the next load knows what is stored without reading it.  A load that failed is written again over what it left.
    A table that was stored without such folders is read for its newest value and stays as it is.
    """
    spark = source.sparkSession
    target = newest_stored(spark, path, source, column)
    newer = newer_than(source, target, column)
    if target is not None and not stored_values(spark, path, LOADED_UPTO):
        newer.write.mode("append").parquet(path)
        return
    upto = newer.select(F.max(column).cast("string")).first()[0]
    if upto is not None:
        # What arrives in the meantime belongs to the next load.
        load = newer.where(F.col(column) <= F.lit(upto).cast(source.schema[column].dataType))
        load.withColumn(LOADED_UPTO, F.lit(upto)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOADED_UPTO).parquet(path)


def to_json_records(df: DataFrame) -> DataFrame:
    """Rows as JSON text with lower-case field names, for a dashboard."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return lowered.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    df.write.mode(mode).format("jdbc").options(url=url, dbtable=table, **properties).save()
