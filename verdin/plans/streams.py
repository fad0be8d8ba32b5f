"""Streaming queries next to their batch twins.

Each event announces one object: the key holds the mail of a customer and the
event type gives the file extension. Customers with a positive balance are approved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.plans.registry import query
from verdin.plans.scoring import rounded
from verdin.plans.trends import TRENDS_QUERY, posts
from verdin.session import read_table, scratch_path
from verdin.streaming import live_trends, routing, weekly

ALLOWED = ("wav", "mp3")


def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    ending = F.when(F.col("event_type") == "error", F.lit("txt")).otherwise(F.lit("WAV"))
    owner = F.when(F.col("event_type") == "signup", F.lit("nobody")).otherwise(
        F.concat(F.lit("C"), F.col("user_id").cast("string"), F.lit("@Example.com"))
    )
    key = F.concat(F.lit("calls/"), owner, F.lit("/"), F.col("event_type"), F.lit("+"), (F.col("event_id") / 3).cast("bigint").cast("string"), F.lit("."), ending)
    return read_table(spark, folder, "events").select("event_id", "event_type", key.alias("key"))


def approved(spark: SparkSession, folder: str) -> DataFrame:
    mail = F.concat(F.lit(" c"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    return read_table(spark, folder, "customer").where("c_acctbal > 0").select(mail.alias("Correo"))


ROUTED_SQL = """k AS (SELECT event_id, event_type, user_id, 'calls/' || CASE WHEN event_type = 'signup' THEN 'nobody' ELSE 'C' || user_id || '@Example.com' END
      || '/' || event_type || ' ' || (event_id // 3) || '.' || CASE WHEN event_type = 'error' THEN 'txt' ELSE 'WAV' END AS key FROM events),
    r AS (SELECT k.*, CASE WHEN event_type <> 'signup' THEN 'c' || user_id || '@example.com' END AS mail,
      CASE WHEN event_type = 'error' THEN 'ext_not_allowed' WHEN event_type = 'signup' THEN 'no_email_in_key'
        WHEN c.c_custkey IS NULL THEN 'correo_no_aprobado' END AS reason
      FROM k LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = k.user_id)"""


@query("j13_st1_route_batch", f"WITH {ROUTED_SQL} SELECT event_id, key, mail, reason FROM r")
def route_batch(spark, folder):
    records = object_keys(spark, folder).withColumn("key", F.replace("key", F.lit("+"), F.lit(" ")))
    allow_list = routing.approved_mails(approved(spark, folder), ["correo", "email"])
    return routing.route(records, allow_list, ALLOWED).select("event_id", "key", "mail", "reason")


def notifications(keys: DataFrame) -> DataFrame:
    """Keys as the notification documents an object store sends."""
    record = F.struct(
        F.struct(F.struct(F.lit("inbox").alias("name")).alias("bucket"), F.struct(F.col("key").alias("key")).alias("object")).alias("s3")
    )
    return keys.select(F.array(record).alias("Records"))


def run_stream(spark: SparkSession, folder: str, output: str | None = None) -> str:
    """Route all notifications as a stream of several files in two batches, with a new checkpoint, and return the output folder."""
    base = scratch_path(spark, "routing")
    output = output or f"{base}/out"
    approved(spark, folder).write.parquet(f"{base}/approved")
    files = 2 * max(1, spark.sparkContext.defaultParallelism // 2)
    notifications(object_keys(spark, folder)).repartition(files).write.json(f"{base}/inbox")
    stream = routing.read_notifications(spark, f"{base}/inbox", files_per_batch=files // 2)
    routing.run_routing(
        stream, f"{base}/approved", ["Correo"], ALLOWED, output, f"{base}/checkpoint", "20240301-120000"
    ).awaitTermination()
    return output


@query("st1_s15_route_stream", f"WITH {ROUTED_SQL} SELECT coalesce(reason, 'processed') AS reason, mail, count(*) AS n FROM r GROUP BY 1, 2")
def route_stream(spark, folder):
    out = run_stream(spark, folder)
    reason = F.coalesce("reason", F.lit("processed")).alias("reason")
    return routing.outcomes(spark, out).select(reason, "mail").groupBy("reason", "mail").agg(F.count(F.lit(1)).alias("n"))


@query(
    "st2_start_once",
    f"""WITH {ROUTED_SQL} SELECT key, CAST(1 AS BIGINT) AS started, count(*) - 1 AS repeats FROM r WHERE reason IS NULL GROUP BY 1""",
)
def start_once(spark, folder):
    started = F.count_if(F.col("status") == "started")
    repeats = F.count_if(F.col("status") == "already_exists")
    rows = routing.processed(spark, run_stream(spark, folder))
    return rows.groupBy("key").agg(started.alias("started"), repeats.alias("repeats"))


@query(
    "st3_refreshed_allow_list",
    f"""WITH {ROUTED_SQL} SELECT CASE WHEN event_type <= 'error' THEN coalesce(reason, 'processed')
          WHEN event_type = 'signup' THEN 'no_email_in_key' ELSE 'correo_no_aprobado' END AS reason, count(*) AS n FROM r GROUP BY 1""",
)
def refreshed_allow_list(spark, folder):
    """The list is emptied between two runs of one stream, so nothing is approved in the second."""
    base = scratch_path(spark, "refresh")
    keys = object_keys(spark, folder)
    mails = approved(spark, folder)
    _two_runs(
        base,
        [keys.where("event_type <= 'error'"), keys.where("event_type > 'error'")],
        [mails, mails.select(F.lit("nobody@example.com").alias("Correo")).limit(1)],
    )
    rows = routing.outcomes(spark, f"{base}/out").select(F.coalesce("reason", F.lit("processed")).alias("reason"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _two_runs(base: str, inputs: list[DataFrame], lists: list[DataFrame]) -> None:
    for keys, mails in zip(inputs, lists, strict=True):
        mails.write.mode("overwrite").parquet(f"{base}/approved")
        notifications(keys).write.mode("append").json(f"{base}/inbox")
        stream = routing.read_notifications(keys.sparkSession, f"{base}/inbox")
        routing.run_routing(
            stream, f"{base}/approved", ["correo"], ALLOWED, f"{base}/out", f"{base}/checkpoint", "20240301-120000"
        ).awaitTermination()


@query(
    "st4_resume",
    f"WITH {ROUTED_SQL} SELECT event_type, count(*) AS n FROM r GROUP BY 1",
)
def resume(spark, folder):
    """Two runs over a growing folder with one checkpoint see every notification once."""
    base = scratch_path(spark, "resume")
    keys, mails = object_keys(spark, folder), approved(spark, folder)
    _two_runs(base, [keys.where("event_type <= 'error'"), keys.where("event_type > 'error'")], [mails, mails])
    seen = routing.outcomes(spark, f"{base}/out").select(F.regexp_extract("key", r"([a-z]+) \d+\.\w+$", 1).alias("event_type"))
    return seen.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


WEEKS_SQL = """SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, count(*) AS n, round(sum(value), 4) AS total,
    date_trunc('second', min(ts)) AS first_moment FROM events GROUP BY 1, 2"""


def _tidy_weeks(df: DataFrame) -> DataFrame:
    return rounded(df.withColumn("first_moment", F.date_trunc("second", F.col("first_moment").cast("timestamp")).cast("timestamp_ntz")), 4)


@query("st5_week_feed_batch", WEEKS_SQL)
def week_feed_batch(spark, folder):
    return _tidy_weeks(weekly.week_aggregates(read_table(spark, folder, "events"), "ts", ["event_type"], "value"))


@query("st5_week_feed_stream", WEEKS_SQL)
def week_feed_stream(spark, folder):
    base = scratch_path(spark, "weeks")
    schema = read_table(spark, folder, "events").schema
    feed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    weekly.run_week_feed(feed, "ts", ["event_type"], "value", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _tidy_weeks(weekly.latest_weeks(spark, f"{base}/out", ["event_type"]))


@query("st5_live_trends", TRENDS_QUERY)
def live_weekly_trends(spark, folder):
    """Posts arrive in two parts, with a restart between them; a last row closes the feed."""
    base = scratch_path(spark, "live-trends")
    rows = posts(spark, folder)
    middle, after = 45322.0, 45422.0
    last = live_trends.closing_row(rows, {"post_date": after})
    for part in (rows.where(F.col("post_date") < middle), rows.where(F.col("post_date") >= middle).unionByName(last)):
        part.write.mode("append").parquet(f"{base}/feed")
        feed = spark.readStream.schema(last.schema).parquet(f"{base}/feed")
        live_trends.run_trend_feed(feed, "origin", "post_date", "reason", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return rounded(live_trends.closed_trends(spark, f"{base}/out"))
