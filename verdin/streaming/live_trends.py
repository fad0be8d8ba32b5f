"""Weekly trends on a live feed: posts, frequent words and interaction quantiles of closed weeks.

One stateful aggregation serves all three. A post becomes one row for itself, one per
keyword and one for its interactions, and the state counts rows per week, origin, word and
value. A week is written once, when the watermark has passed its end, and its state is dropped
then. Top words and exact quantiles come from the written counts, so nothing but counts
is ever kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from verdin.functions.text import post_keywords
from verdin.operators import ordered, trends
from verdin.streaming.weekly import MONDAY, WEEK

SCHEMA = "week STRING, origin STRING, word STRING, value DOUBLE, n BIGINT, first_day DATE, kind STRING"


def trend_counts(feed: DataFrame, origin: str, moment: str, text: str, late: str = "1 day") -> DataFrame:
    """Rows per week, origin, kind (``post``, ``word``, ``value`` or ``end``), word and value, for batches and streams alike.

    Posts without origin only move the watermark; they are counted as ``end``.
    Posts without moment are dropped.
    """
    timed = feed.withColumn("_at", trends.post_moment(feed, moment).cast("timestamp")).withWatermark("_at", late)
    tidy = trends.tidy_posts(timed, origin, "_at", text, ["_at"])

    def item(kind: str, word=None, value=None):
        return F.struct(F.lit(kind).alias("kind"), _or_null(word, "string").alias("word"), _or_null(value, "double").alias("value"))

    value = F.when(F.col("interactions").isNotNull(), F.array(item("value", value=F.col("interactions")))).otherwise(F.array())
    words = F.transform(post_keywords(F.col("text")), lambda word: item("word", word))
    items = F.when(F.col("origin").isNull(), F.array(item("end"))).otherwise(F.concat(F.array(item("post")), value, F.coalesce(words, F.array())))
    rows = tidy.select("_at", "week", "origin", "day", F.explode(items).alias("item")).select("*", "item.*")
    window = F.window("_at", WEEK, startTime=MONDAY)
    counted = rows.groupBy(window.alias("_window"), "week", "origin", "kind", "word", "value")
    return counted.agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day")).drop("_window")


def _or_null(value, kind: str):
    return (F.lit(None) if value is None else value).cast(kind)


def run_trend_feed(feed: DataFrame, origin: str, moment: str, text: str, output: str, checkpoint: str, late: str = "1 day") -> StreamingQuery:
    """Count the present input into the state and write the counts of weeks that are closed.

    A week is closed when the latest moment seen is more than ``late`` after its end; rows of closed weeks
    are dropped. The file sink's log makes a repeated batch count once, also after a
    restart from ``checkpoint``.
    """
    counts = trend_counts(feed, origin, moment, text, late)
    writer = counts.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").partitionBy("kind").trigger(availableNow=True).start()


def closing_row(feed: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """One row that closes a used-up feed: ``values`` holds a moment well after the last week, all other columns are null."""
    fields = [T.StructField(f.name, f.dataType, True) for f in feed.schema.fields]
    row = tuple(values.get(field.name) for field in fields)
    return feed.sparkSession.createDataFrame([row], T.StructType(fields))


def closed_trends(spark: SparkSession, output: str, k: int = 20) -> DataFrame:
    """``trends.weekly_trends`` of the closed weeks, from the written counts."""
    counts = spark.read.schema(SCHEMA).parquet(output)
    keys = trends.TREND_KEYS
    base = counts.where("kind = 'post'").select(*keys, F.col("n").alias("posts"), "first_day")
    words = trends.listed_words(counts.where("kind = 'word'").select(*keys, "word", "n"), keys, k)
    shares = ordered.quantiles_of_counts(counts.where("kind = 'value'"), "value", "n", trends.SHARES, keys)
    return trends.trend_table(base, words, shares)
