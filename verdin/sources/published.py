"""Tables that change as a whole: versioned folders and a manifest that names the folders of each version.

Rows are written to a folder that nothing refers to yet, audited there, and published by one
small file. Spark moves that file into place when its job commits, so a reader sees the old
version or the new one, never half, and a write that fails or is killed leaves the table as it was.
Appending names the earlier folders again and copies no row. There is one writer at a time; readers
that have started keep the folders they know, as nothing is removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "version BIGINT, folders ARRAY<STRING>, rows BIGINT, layout STRING"


class AuditFailed(RuntimeError):
    """Staged rows that did not pass; the table is unchanged."""


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """All published versions of a table: ``version``, ``folders``, ``rows`` added, ``layout``; none before the first."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/published/*")
    except AnalysisException:
        return None


def _latest(spark: SparkSession, path: str):
    known = versions(spark, path)
    return None if known is None else known.orderBy(F.desc("version")).first()  # one row per version


def publish(
    df: DataFrame,
    path: str,
    append: bool = False,
    checks: Mapping[str, Column] | None = None,
    audit: Callable[[DataFrame], None] | None = None,
) -> int:
    """Write ``df`` as the next version of the table, alone or after the rows it has; returns the number of rows added.

    ``checks`` are conditions that every row must meet; rows and violations are counted while they are
    written. ``audit`` may look at the staged rows and raise. The layout of appended rows must be the
    table's; missing columns are null, unknown ones are refused.
    """
    spark = df.sparkSession
    before = _latest(spark, path)
    if append and before is not None:
        layout = T.StructType.fromJson(json.loads(before.layout))
        df = _laid_out(df, layout)
    number = 1 if before is None else before.version + 1
    folder = f"{path}/versions/{number}-{uuid.uuid4().hex}"
    seen = Observation()
    broken = {f"broken_{k}": F.count_if(~F.coalesce(one, F.lit(False))) for k, one in enumerate((checks or {}).values())}
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[one.alias(name) for name, one in broken.items()]).write.parquet(folder)
    failed = {name: seen.get[f"broken_{k}"] for k, name in enumerate(checks or {}) if seen.get[f"broken_{k}"]}
    if failed:
        raise AuditFailed(f"rows that fail: {failed}")
    if audit is not None:
        audit(spark.read.schema(df.schema).parquet(folder))
    folders = [*(before.folders if append and before is not None else []), folder]
    row = spark.createDataFrame([(number, folders, seen.get["rows"], df.schema.json())], MANIFEST)
    row.coalesce(1).write.json(f"{path}/published/{number}")
    return seen.get["rows"]


def _laid_out(df: DataFrame, layout: T.StructType) -> DataFrame:
    unknown = [name for name in df.columns if name not in layout.names]
    if unknown:
        raise ValueError(f"not in the table: {unknown}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout.fields])


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest version of a table, or an earlier one by its number."""
    known = versions(spark, path)
    row = None if known is None else known.where(F.lit(True) if version is None else F.col("version") == version).orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no such version at {path}")
    layout = T.StructType.fromJson(json.loads(row.layout))
    return spark.read.schema(layout).parquet(*row.folders)
