"""Reading tables, delimited files, text corpora and file inventories."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdin.operators.columns import tidy_header
from verdin.session import shuffle_width

#: Files, and bytes of their contents, that a task hands on at a time; a longer file goes alone.
HANDED_FILES, HANDED_BYTES = 1000, 4 << 20


def extract(
    spark: SparkSession,
    source: str,
    query: str | None = None,
    connection: Mapping[str, str] | None = None,
    partition: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a query over JDBC, or of parquet.

    ``source`` is a JDBC address or a parquet path; the query of a parquet
    source names its table ``source``. ``partition`` holds the JDBC options
    partitionColumn, lowerBound, upperBound and numPartitions, so that executors
    read in parallel; Spark requires ``dbtable`` for these, so the query becomes
    a derived table.
    """
    if source.startswith("jdbc:"):
        reader = spark.read.format("jdbc").option("url", source).options(**dict(connection or {}))
        if partition:
            return reader.options(**dict(partition)).option("dbtable", f"({query}) AS q").load()
        return reader.option("query", query).load()
    frame = spark.read.parquet(source)
    if query is None:
        return frame
    return spark.sql(query.replace("source", "{source}", 1), source=frame)


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ","
) -> DataFrame:
    """Delimited text with a header; gzip files are read as they are."""
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", False)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_text_columns(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Delimited text with every column a string, nothing read as null, header in lower case."""
    frame = tidy_header(spark.read.option("header", True).option("sep", sep).option("emptyValue", "").csv(path))
    return frame.fillna("")


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """Dispatch by extension: csv, csv.gz, json, parquet."""
    name = path.lower()
    if name.endswith((".csv", ".csv.gz")):
        return read_delimited(spark, path)
    if name.endswith(".json"):
        return spark.read.json(path)
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported format: {path}")


def read_corpus(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """One row per text file below a folder: path, file name, size and whole text.

    Files that are not valid UTF-8 are decoded as Latin-1. Empty files give no row, nor do hidden ones,
    as with Spark's readers. A local or mounted folder is listed and read by tasks, each time the rows are
    asked for; other stores are listed once, by Spark on the driver.
    """
    root = _local_root(spark, folder)
    if root is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        files = reader.load(folder)
    else:
        files = _local_files(spark, root, pattern)
    text = F.coalesce(_valid_utf8(F.col("content")), F.decode(F.col("content"), "ISO-8859-1"))
    return files.select(
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size"),
        text.alias("text"),
    )


def _local_root(spark: SparkSession, folder: str) -> str | None:
    """The plain path of a local or mounted folder; None for other stores, single files and patterns of folders."""
    scheme = urlsplit(folder).scheme or urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")).scheme
    path = re.sub("/+", "/", re.sub("^(file:)?(//)?(?=/)", "", folder))
    return path if scheme == "file" and path.startswith("/") and os.path.isdir(path) else None


def _local_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Path, length and content of the files below a folder, found and read by tasks.

    Spark's reader keeps every file it finds on the driver. Here folders are listed in tasks, two levels dealt
    out one after the other and what is below by one task a folder; the files are dealt out by path.
    """
    width = shuffle_width(spark)
    found = spark.createDataFrame([(root, True)], "place string, folder boolean")
    for deep in (False, False, True):
        found = found.mapInArrow(_listing(deep), found.schema).repartition(width, "place")
    named = f"(?s)^(?:{spark._jvm.org.apache.hadoop.fs.GlobPattern.compile(pattern).pattern()})$"
    files = found.where(F.element_at(F.split("place", "/"), -1).rlike(named)).select("place")
    return files.mapInArrow(_contents, "path string, length long, content binary")


def _listing(deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Folders are replaced by what is in them, files stay; ``deep`` goes down to the files."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool]]:
        for batch in batches:
            for place, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not folder:
                    yield place, False
                below = [place] if folder else []
                while below:
                    with os.scandir(below.pop()) as inside:
                        for entry in inside:
                            if _hidden(entry):
                                continue
                            if deep and entry.is_dir():
                                below.append(entry.path)
                            elif entry.is_dir() or entry.is_file():
                                yield entry.path, entry.is_dir()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _portions(entries(batches), lambda entry: 0):
            arrays = [pa.array([e[0] for e in some], pa.string()), pa.array([e[1] for e in some], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["place", "folder"])

    return run


def _hidden(entry: os.DirEntry) -> bool:
    """What Spark's readers pass over."""
    name = entry.name
    marked = name.startswith("_") and "=" not in name and not (name.startswith(("_metadata", "_common_metadata")) and entry.is_dir())
    return marked or name.startswith(".") or name.endswith("._COPYING_")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def files() -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                with open(place, "rb", buffering=0) as file:
                    body = file.readall()
                if body:
                    yield f"file:{place}", body

    for some in _portions(files(), lambda file: len(file[1])):
        sizes = pa.array([len(f[1]) for f in some], pa.int64())
        arrays = [pa.array([f[0] for f in some], pa.string()), sizes, pa.array([f[1] for f in some], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["path", "length", "content"])


def _portions(items: Iterator[tuple], weight: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    """At most ``HANDED_FILES`` items of ``HANDED_BYTES`` together at a time."""
    some, held = [], 0
    for item in items:
        more = weight(item)
        if some and (len(some) == HANDED_FILES or held + more > HANDED_BYTES):
            yield some
            some, held = [], 0
        some.append(item)
        held += more
    if some:
        yield some


def _valid_utf8(content: Column) -> Column:
    return F.try_validate_utf8(content.cast("string"))


def file_inventory(spark: SparkSession, folder: str, extensions: Sequence[str]) -> DataFrame:
    """Path, name, size and modification time of files by extension; contents are not read."""
    choice = "*.{" + ",".join(e.lstrip(".") for e in extensions) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", choice)
    return files.load(folder).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def union_column(inputs: Sequence[DataFrame], column: str) -> DataFrame:
    """One text column from all inputs that have it; inputs without it are skipped."""
    parts = [df.select(F.col(column).cast("string").alias(column)) for df in inputs if column in df.columns]
    if not parts:
        raise ValueError(f"no input has the column {column}")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
