"""Resumable landing of files: what to send, where to, and what was sent before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def target_key(prefix: str, relative: Column) -> Column:
    """``prefix/relative`` without outer slashes in the prefix."""
    tidy = prefix.strip("/")
    return F.concat_ws("/", F.lit(tidy), relative) if tidy else relative


def dated_key(prefix: str, role: Column, mail: Column, day: Column, name: Column) -> Column:
    """``prefix/role/mail/date/name``, the name without plus signs."""
    return target_key(prefix, F.concat_ws("/", role, mail, F.date_format(day, "yyyy-MM-dd"), landing_name(name)))


def plan_landing(files: DataFrame, manifest: DataFrame, present: DataFrame | None = None, dry_run: bool = False):
    """Add the ``action`` for each file (path, key, size).

    Listed in the manifest (path) beats present at the target (key); the rest
    is uploaded, or would be in a dry run.
    """
    done = manifest.select(F.col("path").alias("_done")).distinct()
    planned = files.join(done, F.col("path") == F.col("_done"), "left")
    if present is not None:
        there = present.select(F.col("key").alias("_there")).distinct()
        planned = planned.join(there, F.col("key") == F.col("_there"), "left")
    else:
        planned = planned.withColumn("_there", F.lit(None).cast("string"))
    action = (
        F.when(F.col("_done").isNotNull(), F.lit("skip_manifest"))
        .when(F.col("_there").isNotNull(), F.lit("skip_present"))
        .otherwise(F.lit("dry_run" if dry_run else "upload"))
    )
    return planned.select(*files.columns, action.alias("action"))


def with_outcomes(planned: DataFrame, failures: DataFrame) -> DataFrame:
    """Uploads that failed get the action ``failed``; ``failures`` has their paths."""
    lost = failures.select(F.col("path").alias("_lost")).distinct()
    joined = planned.join(lost, F.col("path") == F.col("_lost"), "left")
    failed = (F.col("action") == "upload") & F.col("_lost").isNotNull()
    return joined.withColumn("action", F.when(failed, F.lit("failed")).otherwise(F.col("action"))).drop("_lost")


def landing_counters(planned: DataFrame) -> DataFrame:
    """Total, uploaded (dry runs count), skipped and failed files."""
    skipped, failed = F.count_if(F.col("action").startswith("skip")), F.count_if(F.col("action") == "failed")
    total = F.count(F.lit(1))
    return planned.agg(
        total.alias("total"), (total - skipped - failed).alias("uploaded"), skipped.alias("skipped"), failed.alias("failed")
    )


def manifest_additions(planned: DataFrame) -> DataFrame:
    """Rows to append to the manifest: everything sent now or found at the target."""
    return planned.where(F.col("action").isin("upload", "skip_present")).select("path", "key", "size")


def changed_files(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files to copy: absent at the target, or there with another size. Both have key and size."""
    side = target.groupBy(F.col("key").alias("_key")).agg(F.max("size").alias("_size"))
    joined = source.join(side, F.col("key") == F.col("_key"), "left")
    return joined.where(F.col("_size").isNull() | (F.col("_size") != F.col("size"))).select(*source.columns)


def landing_name(name: Column) -> Column:
    """File name without plus signs."""
    return F.replace(name, F.lit("+"), F.lit(""))
