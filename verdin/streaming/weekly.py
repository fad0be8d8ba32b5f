"""Weekly counts on a live feed, with a bound for late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WEEK = "7 days"
MONDAY = "4 days"  # windows count from 1970-01-01, a Thursday


def week_aggregates(feed: DataFrame, moment: str, keys: Sequence[str], value: str) -> DataFrame:
    """Rows and value sum per Monday week and keys; for batches and streams alike."""
    week = F.window(F.col(moment).cast("timestamp"), WEEK, startTime=MONDAY)
    return (
        feed.groupBy(week.alias("_week"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(moment).alias("first_moment"))
        .select(F.to_date("_week.start").alias("week_start"), *keys, "n", "total", "first_moment")
    )


def run_week_feed(
    feed: DataFrame, moment: str, keys: Sequence[str], value: str, output: str, checkpoint: str, late: str = "1 day"
) -> StreamingQuery:
    """Write changed weeks of each batch; state older than the latest row minus ``late`` is dropped."""
    timed = feed.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, late)

    def one_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    changed = week_aggregates(timed, moment, keys, value)
    writer = changed.writeStream.outputMode("update").foreachBatch(one_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_weeks(spark: SparkSession, output: str, keys: Sequence[str]) -> DataFrame:
    """The last written state of each week and key."""
    written = spark.read.parquet(output)
    values: list[Column] = [F.max_by(F.struct("n", "total", "first_moment"), "batch").alias("_last")]
    return written.groupBy("week_start", *keys).agg(*values).select("week_start", *keys, "_last.*")
