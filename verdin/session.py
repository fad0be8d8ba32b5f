"""Session settings, table reading and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. Sizes are left to the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a batch on its way to Python is bounded by its bytes (64 MB before): texts differ much in length
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # a written table needs its shuffle files no longer; else they stay until the driver collects its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # keyed state of streams lives on disk and is saved as changes
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


TEXT_PARTITIONS = "verdin.text.partitions"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a dataset folder."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def read_texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with long texts.

    A file of a single row group is one task however many cores there are. A
    deployment with such inputs may set ``verdin.text.partitions`` to deal the rows out; it is
    unset by default, and nothing is shuffled then.
    """
    table = read_table(spark, folder, name)
    parts = spark.conf.get(TEXT_PARTITIONS, None)
    return table.repartition(int(parts)) if parts else table


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder the session names for checkpoints.

    A cluster must name one in ``spark.checkpoint.dir``; only a local session
    may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="spark-checkpoints-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for one written table."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder.

    Used where a plan reads a frame twice and both reads must see the same
    partition numbers, also after an executor is lost.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read from there.

    Serves where a frame is read more than once and its partitions don't matter. The shuffle files
    behind it go as soon as it is written; those behind a checkpoint stay. Calendar intervals, which
    Parquet does not hold, are pinned.
    """
    if "CalendarInterval" in repr(df.schema):
        return pinned(df)
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
