"""Writing tables: staged load, replacement, named exports and JSON reports."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadResult:
    rows_in: int
    rows_inserted: int
    staging: str


def staged_load(
    df: DataFrame, table: str, staging_path: str, suffix: str = "_staging", truncate: bool = False
) -> LoadResult:
    """Write to a staging table shaped like the destination, then insert from it.

    Rows reach the destination in one statement; how far a failed one is undone is up to
    the table's format (``published`` keeps plain files whole). The staging table is dropped at
    the end. Rows in are those staged, rows inserted those that the insert wrote; a difference raises.
    """
    spark = df.sparkSession
    staging = f"{table}{suffix}"
    shape = spark.table(table)
    missing = [c for c in df.columns if c not in shape.columns]
    if missing:
        raise ValueError(f"not in the destination: {missing}")
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    rows = df.select([F.col(c).cast(shape.schema[c].dataType).alias(c) for c in df.columns])
    rows.write.format("parquet").mode("overwrite").option("path", staging_path).saveAsTable(staging)
    filled = spark.table(staging)
    full = filled.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in shape.schema.fields
        ]
    )
    rows_in, written = filled.count(), Observation()
    counted = full.observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite" if truncate else "append").insertInto(table, overwrite=truncate)
    inserted = written.get["n"]
    spark.sql(f"DROP TABLE {staging}")
    if inserted != rows_in:
        raise RuntimeError(f"{rows_in} rows staged, {inserted} inserted into {table}")
    return LoadResult(rows_in=rows_in, rows_inserted=inserted, staging=staging)


def replace_table(df: DataFrame, table: str, path: str) -> int:
    """Write the table anew and return its row count."""
    spark = df.sparkSession
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(table)
    return spark.table(table).count()


def export_all(frames: Mapping[str, DataFrame], folder: str, kind: str = "parquet") -> dict[str, str]:
    """Write each named frame to its own folder."""
    paths = {}
    for name, frame in frames.items():
        paths[name] = f"{folder}/{name}"
        frame.write.mode("overwrite").format(kind).save(paths[name])
    return paths


def write_delimited(df: DataFrame, path: str, compress: bool = False) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip" if compress else "none").csv(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Folders per value; Spark sizes the files and splits a value that holds many rows."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_texts(df: DataFrame, folder: str, text: str, by: str) -> None:
    """One file per row, its text and a line feed, in folders per value of ``by``.

    Hadoop's local file system starts several processes for each file it creates, to set its mode, so below a
    folder of this kind (which all executors reach) tasks write the files themselves, in folders of a thousand.
    A task that runs again writes the same files again. Any other store gets Spark's text writer.
    """
    address = urlsplit(folder)
    if address.scheme not in ("", "file"):
        df.select(by, text).write.option("maxRecordsPerFile", 1).partitionBy(by).text(folder)
        return
    root = address.path

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for value, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                place = f"{root}/{by}={_folder_name(value)}/{task:05d}-{n // 1000:05d}"
                os.makedirs(place, exist_ok=True)
                with open(f"{place}/{n:09d}.txt", "wb", buffering=0) as file:
                    file.write((body or b"") + b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    os.makedirs(root, exist_ok=True)
    df.select(F.col(by).cast("string"), text).mapInArrow(put, "n long").agg(F.sum("n")).collect()


def _folder_name(value: str | None) -> str:
    """A value as Spark names its folders."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def write_report(df: DataFrame, path: str) -> None:
    """Metrics as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
