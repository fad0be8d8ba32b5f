"""Date functions on events and orders, and weekly trends of posts.

A document stands for a post: its source is the origin, its length the
interactions, and its day is 2024-01-01 plus the id modulo 60, given as a date serial.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions import dates, parsers, text
from verdin.operators import columns, listening, trends
from verdin.plans.registry import query
from verdin.plans.scoring import rounded
from verdin.plans.texts import POST_STOPS, TIDY_SQL, listened
from verdin.session import read_table, read_texts, scratch_path


@query(
    "d1_date_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(week(ts) AS INT) AS week,
       CAST(isodow(ts) - 1 AS INT) AS weekday FROM events""",
)
def date_parts(spark, folder):
    parts = dates.date_parts(F.col("ts"))
    return read_table(spark, folder, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("d2_week_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%W') AS week FROM orders")
def week_label(spark, folder):
    return read_table(spark, folder, "orders").select("o_orderkey", dates.week_label(F.col("o_orderdate")).alias("week"))


@query(
    "d3_serial_and_text_dates",
    """SELECT doc_id, TIMESTAMP '1899-12-30' + to_days(CAST(45292 + doc_id % 60 AS INT)) + to_seconds((doc_id % 4) * 21600) AS from_serial,
       CASE WHEN lang = 'de' THEN NULL ELSE TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 60 AS INT)) END AS from_text FROM documents""",
)
def serial_and_text_dates(spark, folder):
    serial = 45292 + F.col("doc_id") % 60 + (F.col("doc_id") % 4) * 0.25
    day = F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("doc_id") % 60).cast("int")), "yyyy-MM-dd")
    written = F.when(F.col("lang") == "de", F.lit("soon")).otherwise(day)
    return read_table(spark, folder, "documents").select(
        "doc_id", dates.from_serial(serial.cast("double")).alias("from_serial"), dates.parse_moment(written).alias("from_text")
    )


@query(
    "d4_clock_time",
    """SELECT event_id, CASE event_type WHEN 'view' THEN strftime(ts, '%H:%M:%S') || '.0000000'
         WHEN 'click' THEN strftime(ts, '%H:%M') || ':00.0000000'
         WHEN 'error' THEN strftime(date_trunc('minute', ts), '%H:%M:%S') || '.0000000' ELSE '' END AS clock FROM events""",
)
def clock_time(spark, folder):
    minutes = F.hour("ts") * 60 + F.minute("ts")
    written = (
        F.when(F.col("event_type") == "view", F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(".1230000")))
        .when(F.col("event_type") == "click", F.date_format("ts", "HH:mm"))
        .when(F.col("event_type") == "error", F.replace((minutes / 1440).cast("string"), F.lit("."), F.lit(",")))
        .when(F.col("event_type") == "purchase", F.lit("later"))
    )
    return read_table(spark, folder, "events").select("event_id", dates.time7(dates.clock_time(written)).alias("clock"))


@query(
    "d7_format_with_default",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN '2024-03-01' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events",
)
def format_with_default(spark, folder):
    day = F.when(F.col("event_type") != "error", F.col("ts"))
    return read_table(spark, folder, "events").select("event_id", dates.format_date(day, dt.date(2024, 3, 1)).alias("day"))


@query(
    "d8_folder_date",
    "SELECT o_orderkey, month(o_orderdate) || '_' || day(o_orderdate) || '_' || year(o_orderdate) AS folder, CAST(o_orderdate AS DATE) AS day FROM orders",
)
def folder_date(spark, folder):
    name = dates.folder_date(F.col("o_orderdate"))
    return read_table(spark, folder, "orders").select(
        "o_orderkey", name.alias("folder"), dates.parse_folder_date(name).alias("day")
    )


@query(
    "d9_parse_day_first",
    "SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE date_trunc('minute', ts) END AS moment FROM events",
)
def parse_day_first(spark, folder):
    written = F.when(F.col("event_type") == "signup", F.date_format("ts", "MM/dd/yyyy")).otherwise(
        F.date_format("ts", "dd/MM/yyyy HH:mm")
    )
    moment = dates.parse_moment(written, "dd/MM/yyyy HH:mm")
    return read_table(spark, folder, "events").select("event_id", moment.alias("moment"))


@query(
    "p19_interaction_total",
    """SELECT doc_id, CAST(n_chars + CASE WHEN lang = 'de' THEN 0 ELSE length(text) END AS BIGINT) AS total FROM documents""",
)
def interaction_total(spark, folder):
    posts = read_table(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").alias("Likes_total"),
        F.when(F.col("lang") != "de", F.length("text")).alias("n_shares"),
        F.col("source").alias("comment_source"),
    )
    return posts.select("doc_id", columns.interaction_total(posts, trends.INTERACTION_PATTERNS).cast("bigint").alias("total"))


@query(
    "f22_origin_host",
    """SELECT page_id, replace(regexp_extract(lower(url), '^https?://([^/?#]*)', 1), 'www.', '') AS host, 'my page' AS plain FROM pages""",
)
def origin_host(spark, folder):
    return read_table(spark, folder, "pages").select(
        "page_id", parsers.origin_host(F.col("url")).alias("host"), parsers.origin_host(F.lit(" my page ")).alias("plain")
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return read_texts(spark, folder, "documents").select(
        F.when(F.col("lang") != "de", F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com/x")))
        .otherwise(F.col("source"))
        .alias("origin"),
        (45292 + F.col("doc_id") % 60).cast("double").alias("post_date"),
        F.col("text").alias("reason"),
        F.col("n_chars").alias("likes"),
    )


def trend_rows(spark: SparkSession, folder: str) -> DataFrame:
    return trends.weekly_trends(trends.prepare_posts(posts(spark, folder), "origin", "post_date", "reason"))


POSTS_SQL = """posts AS (SELECT CASE WHEN lang <> 'de' THEN source || '.example.com' ELSE source END AS origin,
    strftime(DATE '2024-01-01' + CAST(doc_id % 60 AS INT), '%Y-%W') AS week, DATE '2024-01-01' + CAST(doc_id % 60 AS INT) AS day, text, n_chars FROM documents)"""
TRENDS_SQL = f"""{POSTS_SQL}, toks AS (SELECT week, origin, unnest(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g')), ' '),
        lambda w: length(w) > 3 AND w NOT IN ({POST_STOPS}))) AS word FROM posts),
    cnt AS (SELECT week, origin, word, count(*) AS n, row_number() OVER (PARTITION BY week, origin ORDER BY count(*) DESC, word) AS k FROM toks GROUP BY 1, 2, 3),
    top AS (SELECT week, origin, string_agg(word, ', ' ORDER BY k) AS words FROM cnt WHERE k <= 20 GROUP BY 1, 2),
    base AS (SELECT week, origin, count(*) AS posts, strftime(min(day), '%Y-%m-%d') AS first_day, quantile_cont(CAST(n_chars AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(n_chars AS DOUBLE), 0.75) AS p75 FROM posts GROUP BY 1, 2),
    trends AS (SELECT week, origin, posts, first_day, coalesce(words, '') AS words, p50, p75 FROM base LEFT JOIN top USING (week, origin))"""


TRENDS_QUERY = f"WITH {TRENDS_SQL} SELECT week, origin, posts, first_day, words, round(p50, 6) AS p50, round(p75, 6) AS p75 FROM trends"


@query("a10_a11_weekly_trends", TRENDS_QUERY)
def weekly_trends(spark, folder):
    return rounded(trend_rows(spark, folder))


@query(
    "w4_top_terms_per_group",
    f"WITH {TRENDS_SQL} SELECT week, origin, CAST(k AS INT) AS place, word, n FROM cnt WHERE k <= 20",
)
def top_terms_per_group(spark, folder):
    prepared = trends.prepare_posts(posts(spark, folder), "origin", "post_date", "reason")
    words = prepared.select("week", "origin", F.explode(text.post_keywords(F.col("text"))).alias("word"))
    counts = words.groupBy("week", "origin", "word").agg(F.count(F.lit(1)).alias("n"))
    return trends.top_per_group(counts, ["week", "origin"], [F.desc("n"), F.asc("word")], 20).select(
        "week", "origin", "place", "word", "n"
    )


@query("a12_trend_baseline", f"WITH {TRENDS_SQL} SELECT round(quantile_cont(p50, 0.5), 6) AS p50, round(quantile_cont(p75, 0.5), 6) AS p75 FROM trends")
def trend_baseline(spark, folder):
    return rounded(trends.trend_baseline(trend_rows(spark, folder)))


@query(
    "a13_overall_words",
    f"""WITH {TRENDS_SQL} SELECT word, count(*) AS n FROM (SELECT trim(unnest(string_split(words, ','))) AS word FROM trends)
        WHERE word <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
)
def overall_words(spark, folder):
    return trends.overall_words(trend_rows(spark, folder))


@query("o2_latest_trends", f"WITH {TRENDS_SQL} SELECT week, origin, posts FROM trends ORDER BY week DESC, origin DESC LIMIT 60")
def latest_trends(spark, folder):
    return trends.latest_trends(trend_rows(spark, folder), 60).select("week", "origin", "posts")


@query(
    "s11_named_exports",
    f"""WITH y AS ({TIDY_SQL}), t AS (SELECT topic, count(*) AS n FROM y GROUP BY 1)
    SELECT 'data' AS name, CAST(d.doc_id AS VARCHAR) AS entry, CAST(strlen(d.text) AS BIGINT) AS n FROM documents d
    UNION ALL SELECT 'table', CAST(doc_id AS VARCHAR), CAST(strlen(text) AS BIGINT) FROM documents
    UNION ALL SELECT 'products', 'x', count(*) FROM documents UNION ALL SELECT 'topics', topic, n FROM t""",
)
def named_exports(spark, folder):
    """The four frames of social listening, each written under its name and read back."""
    paths = listening.export_tables(listened(spark, folder), scratch_path(spark, "exports"))
    whole = F.octet_length("comment").cast("bigint")
    entries = {"data": ("comment_id", whole), "table": ("comment_id", whole), "products": ("product", F.col("mentions")), "topics": ("topic", F.col("n"))}
    parts = [
        spark.read.parquet(paths[name]).select(F.lit(name).alias("name"), F.col(entry).alias("entry"), n.alias("n"))
        for name, (entry, n) in entries.items()
    ]
    return reduce(DataFrame.unionByName, parts)
