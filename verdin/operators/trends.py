"""Weekly trends of posts per origin: counts, first day, frequent words, interaction quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdin.functions.dates import from_serial, parse_moment, week_label
from verdin.functions.parsers import origin_host
from verdin.functions.text import post_keywords
from verdin.operators import ordered
from verdin.operators.columns import interaction_total, require
from verdin.operators.ranking import top_per_group

# fixed values: name parts of interaction columns
INTERACTION_PATTERNS = (
    "interac", "interaccion", "engagement", "reaccion", "reacciones", "like", "likes", "me_gusta",
    "comment", "coment", "comentario", "comentarios", "share", "shares", "compart", "compartido", "compartidos",
    "save", "saves", "guard", "guardado", "guardados", "view", "views", "visual", "visualizacion", "visualizaciones",
    "click", "clicks", "clic", "clics",
)


def post_moment(df: DataFrame, column: str) -> Column:
    """Moment of a post from a timestamp, a date serial or a text."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return from_serial(F.col(column).cast("double"))
    if isinstance(kind, T.StringType):
        return parse_moment(F.col(column))
    return F.col(column).cast("timestamp_ntz")


def prepare_posts(posts: DataFrame, origin: str, moment: str, text: str, extra: Sequence[str] = ()) -> DataFrame:
    """Posts with origin host, week label, day and interactions; rows without origin or moment are dropped.

    Null origins are dropped, not turned into a group of their own.
    """
    return tidy_posts(posts, origin, moment, text, extra).where("origin IS NOT NULL AND day IS NOT NULL")


def tidy_posts(posts: DataFrame, origin: str, moment: str, text: str, extra: Sequence[str] = ()) -> DataFrame:
    """``prepare_posts`` with all rows kept."""
    require(posts, [origin, moment, text])
    total = interaction_total(posts, INTERACTION_PATTERNS)
    dated = posts.withColumn("_moment", post_moment(posts, moment))
    return dated.select(
        F.when(F.col(origin).isNotNull(), origin_host(F.col(origin).cast("string"))).alias("origin"),
        week_label(F.col("_moment")).alias("week"),
        F.to_date("_moment").alias("day"),
        F.col(text).alias("text"),
        (F.lit(None) if total is None else total).cast("double").alias("interactions"),
        *extra,
    )


def group_words(prepared: DataFrame, groups: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` most frequent keywords per group, joined; equal counts in word order.

    Words are counted on the map side, and each task sends at most ``k`` words
    per group to the ranking.
    """
    words = prepared.select(*groups, F.explode(post_keywords(F.col("text"))).alias("word"))
    return listed_words(words.groupBy(*groups, "word").agg(F.count(F.lit(1)).alias("n")), groups, k)


def listed_words(counts: DataFrame, groups: Sequence[str], k: int = 20) -> DataFrame:
    """``group_words`` of words that are already counted as ``n``."""
    best = top_per_group(counts, groups, [F.desc("n"), F.asc("word")], k)
    listed = F.array_sort(F.collect_list(F.struct("place", "word")))  # at most k entries
    return best.groupBy(*groups).agg(F.array_join(F.transform(listed, lambda x: x["word"]), ", ").alias("words"))


SHARES = {"p50": 0.5, "p75": 0.75}
TREND_KEYS = ["week", "origin"]


def weekly_trends(prepared: DataFrame, k: int = 20) -> DataFrame:
    """One row per week and origin: posts, first day, frequent words, median and upper quartile of interactions."""
    base = prepared.groupBy(*TREND_KEYS).agg(F.count(F.lit(1)).alias("posts"), F.min("day").alias("first_day"))
    return trend_table(base, group_words(prepared, TREND_KEYS, k), ordered.quantiles(prepared, "interactions", SHARES, TREND_KEYS))


def trend_table(base: DataFrame, words: DataFrame, shares: DataFrame) -> DataFrame:
    """Counts, words and quantiles of each week and origin beside each other."""
    joined = base.join(words, TREND_KEYS, "left").join(shares, TREND_KEYS, "left")
    return joined.withColumns(
        {"words": F.coalesce("words", F.lit("")), "first_day": F.date_format("first_day", "yyyy-MM-dd")}
    ).orderBy(*TREND_KEYS)


def trend_baseline(trends: DataFrame) -> DataFrame:
    """Medians of the group quantiles."""
    low = ordered.quantiles(trends, "p50", {"p50": 0.5})
    high = ordered.quantiles(trends, "p75", {"p75": 0.5})
    return low.select("p50", high.scalar().alias("p75"))


def latest_trends(trends: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` rows, oldest first."""
    return trends.orderBy(F.desc("week"), F.desc("origin")).limit(n).orderBy("week", "origin")


def overall_words(trends: DataFrame, n: int = 30) -> DataFrame:
    """The words listed in most trend rows."""
    words = trends.select(F.explode(F.split("words", ",")).alias("word")).select(F.trim("word").alias("word"))
    counts = words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(n)
