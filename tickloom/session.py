"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Monthly arrays are small: keep more of them in the map tasks' hash
    # tables before falling back on sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session with the settings every job relies on.

    Extra settings are passed with underscores for dots, for example
    ``build_session(spark_sql_shuffle_partitions="4000")``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are UTC dates throughout; pin the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back on a temporary folder: on a cluster it
    would not survive the loss of the machine that holds it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Store a result in the shared folder and read it from there.

    Cuts the lineage, computes the rows once however often they are used, and
    shows every reader the same rows; what is stored outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "frozen")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input files that one task of ``gathered`` stands for.
GATHERED_BYTES = 8 << 20


def input_bytes(df: DataFrame) -> int:
    """Size of the files that a DataFrame is derived from, as stored; 0 if it comes from none."""
    spark, sizes = df.sparkSession, {}
    wanted = {spark._jvm.java.net.URI(f).getPath(): f for f in df.inputFiles()}
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)) for f in wanted.values()]
    for folder in {p.getParent().toString(): p.getParent() for p in paths}.values():
        for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
            sizes[status.getPath().toUri().getPath()] = status.getLen()
    return sum(sizes.get(path, 0) for path in wanted)


def gathered(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key in one task each, in as many tasks as the input's size asks for.

    Adaptive execution sizes tasks by compressed bytes, and narrow rows compress so well that millions meet in a task
    that sorts them.  Where the input gives no more tasks than there are cores, it is left to do so.
    """
    tasks = -(-input_bytes(df) // GATHERED_BYTES)
    return df.repartition(tasks, key) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """What runs within hands Python workers batches of at most so many bytes and a row, unless the session asks for less.

    Otherwise 10,000 rows and 64 MB decide; both ends hold a batch twice while it travels.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(name, str(most_bytes if held <= 0 else min(held, most_bytes)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Share of the driver's heap that may be in use when a scratch table has been stored.
HEAP_SHARE = 0.25


def let_go(spark: SparkSession) -> None:
    """Collect the driver's garbage once more than ``HEAP_SHARE`` of its heap is in use.

    Plans of stored tables are garbage, yet a job of many small tables makes the heap grow to its limit rather than be
    collected, and their shuffles and broadcasts stay for as long.  A full collection also gives heap back to the system.
    """
    heap = spark._jvm.Runtime.getRuntime()
    if heap.totalMemory() - heap.freeMemory() > HEAP_SHARE * heap.maxMemory():
        spark._jvm.System.gc()


class Scratch:
    """Tables of one job in the shared folder, removed together once nothing reads them any more.

    Rows of lazy results may still come from these tables: close only after the
    results are stored elsewhere.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, label: str) -> str:
        self.paths.append(scratch_path(self.spark, label))
        return self.paths[-1]

    def keep(self, df: DataFrame, label: str = "frozen", **options: str) -> DataFrame:
        """As ``freeze``, under this job."""
        path = self.path(label)
        df.write.options(**options).parquet(path)
        let_go(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self, *paths: str) -> None:
        """Remove the given folders of this job, or all."""
        for path in paths or tuple(self.paths):
            remove(self.spark, path)
            self.paths.remove(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whichever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, on whichever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).rename(where, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} cannot be moved to {to}")
