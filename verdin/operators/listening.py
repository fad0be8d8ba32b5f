"""Social listening: tidied classifier answers, derived columns, the fixed table, product and topic rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdin.functions import labels
from verdin.functions.dates import date_parts
from verdin.functions.text import top_words
from verdin.operators.columns import fixed_schema
from verdin.sources.staged import export_all

COMMENT_TABLE = {
    "comment_id": "string", "post": "string", "comment": "string", "moment": "timestamp_ntz", "origin": "string",
    "sentiment": "string", "kind": "string", "topic": "string", "class": "string", "reason": "string",
    "post_topic": "string", "post_class": "string", "year": "int", "month": "int", "week": "int", "weekday": "int",
    "polarity": "double", "tone": "string", "keywords": "string",
}


def tidy_answers(df: DataFrame) -> DataFrame:
    """Columns from the raw structs ``answer`` (of the comment) and ``post_answer`` (topic, class, product)."""
    tidied = df.withColumn("_tidy", labels.tidy_comment(F.col("comment"), F.col("answer")))
    post_topic = labels.topic(F.col("post"), F.col("post_answer")["topic"])
    return tidied.select(
        *[c for c in df.columns if c not in ("answer", "post_answer")],
        "_tidy.*",
        post_topic.alias("post_topic"),
        F.coalesce(F.col("post_answer")["class"], F.lit("otro")).alias("post_class"),
        labels.product(F.col("post_answer")["product"]).alias("product"),
    )


def enrich(df: DataFrame) -> DataFrame:
    """Date parts, polarity, tone and the five most frequent words of each comment."""
    derived = date_parts(F.col("moment")) | {
        "polarity": labels.sentiment_polarity(F.col("sentiment")),
        "tone": labels.tone(F.col("sentiment")),
        "keywords": top_words(F.col("comment")),
    }
    return df.withColumns(derived)


def rank_products(df: DataFrame, column: str = "product", n: int = 60) -> DataFrame:
    """The ``n`` products mentioned most; entries that are no product are left out."""
    named = df.select(F.lower(F.trim(F.col(column))).alias("product")).where(~F.col("product").isin(*labels.NO_RANK))
    counts = named.groupBy("product").agg(F.count(F.lit(1)).alias("mentions"))
    return counts.orderBy(F.desc("mentions"), F.asc("product")).limit(n)


def listening_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The frames to export: all columns, the fixed table, product ranking and topics."""
    data = enrich(tidy_answers(df))
    return {"data": data} | _made_of(data)


def _made_of(data: DataFrame) -> dict[str, DataFrame]:
    topics = data.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return {"table": fixed_schema(data, COMMENT_TABLE), "products": rank_products(data), "topics": topics}


def export_tables(df: DataFrame, folder: str) -> dict[str, str]:
    """``listening_tables`` written below ``folder``: the columns are derived once, the other frames come from those as written."""
    paths = export_all({"data": enrich(tidy_answers(df))}, folder)
    return paths | export_all(_made_of(df.sparkSession.read.parquet(paths["data"])), folder)
