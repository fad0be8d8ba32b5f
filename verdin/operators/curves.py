"""Ranking metrics from one score table: ROC points, AUC, average precision, metrics at the top M.

Rows are first counted per distinct score, so ties form one step and the order
runs over distinct scores only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdin.operators import ordered


def score_steps(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per distinct score, best first: its positives and negatives and those down to it."""
    counted = df.groupBy(F.col(p).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    return ordered.running_totals(counted, [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")})


def ranking_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Area under the ROC curve (ties count half) and average precision (step form)."""
    steps = score_steps(df, y, p)
    sums = steps.agg(
        F.sum("pos").alias("_pos"),
        F.sum("neg").alias("_neg"),
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("_area"),
        F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("_steps"),
    )
    both = F.when((F.col("_pos") > 0) & (F.col("_neg") > 0), F.col("_pos") * F.col("_neg"))
    return sums.select(
        (F.col("_area") / both).alias("roc_auc"),
        (F.col("_steps") / F.when(F.col("_pos") > 0, F.col("_pos"))).alias("avg_precision"),
    )


def roc_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One point per distinct score plus the origin, whose threshold is null."""
    steps = score_steps(df, y, p)
    whole = steps.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    positives = F.lit(float(whole["pos"] or 0) or None).cast("double")
    negatives = F.lit(float(whole["neg"] or 0) or None).cast("double")
    points = steps.select(
        F.col("score").alias("threshold"),
        (F.col("fp") / negatives).alias("fpr"),
        (F.col("tp") / positives).alias("tpr"),
    )
    origin = df.sparkSession.sql("SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0D AS fpr, 0.0D AS tpr")
    return origin.unionByName(points)


def metrics_at_top(df: DataFrame, m: int, key: str, y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall and lift among the ``m`` best scores; equal scores are taken by ``key``."""
    placed = ordered.row_number(df.select(y, p, key), [F.desc(p), F.asc(key)], "_place")
    inside = F.col("_place") <= m
    hits = F.sum(F.when(inside, F.col(y)))
    precision = F.avg(F.when(inside, F.col(y)))
    return placed.agg(
        precision.alias("precision_at_m"),
        (hits / F.sum(y)).alias("recall_at_m"),
        (precision / F.avg(y)).alias("lift_at_m"),
    )
