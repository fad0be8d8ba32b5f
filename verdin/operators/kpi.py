"""Expected-versus-actual tables, KPI blocks with intervals, threshold metrics and count adjustment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.functions.numbers import clip, ratio
from verdin.operators import ordered

Z95 = 1.96  # normal quantile of a two-sided 95 % interval


def control_table(df: DataFrame, segment: str, y: str = "y", p: str = "p") -> DataFrame:
    """Rows, expected and actual positives per segment (a null segment is one), largest error first."""
    error = F.col("expected") - F.col("actual")
    return (
        df.groupBy(segment)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(clip(F.col(p), 0.0, 1.0)).alias("expected"),
            F.sum(y).alias("actual"),
        )
        .withColumns({"error": error, "abs_error": F.abs(error)})
        .orderBy(F.desc("abs_error"), F.asc(segment))
    )


def kpi_columns(p: Column, clamp: bool = False) -> list[Column]:
    """Aggregates of one KPI block: size, expected count, its 95 % interval, and the same as rates.

    A plain list of columns, so it serves global and per-segment blocks alike.
    ``clamp`` keeps the interval inside [0, n].
    """
    inside = clip(p, 0.0, 1.0)
    n = F.count(F.lit(1))
    expected = F.coalesce(F.sum(inside), F.lit(0.0))
    half = F.lit(Z95) * F.sqrt(F.coalesce(F.sum(inside * (1 - inside)), F.lit(0.0)))
    low, high = expected - half, expected + half
    if clamp:
        low, high = F.greatest(F.lit(0.0), low), F.least(n.cast("double"), high)
    size = F.when(n > 0, n)
    return [
        n.alias("n"),
        expected.alias("expected"),
        low.alias("ci_low"),
        high.alias("ci_high"),
        (expected / size).alias("rate"),
        (low / size).alias("rate_low"),
        (high / size).alias("rate_high"),
    ]


def kpi_block(df: DataFrame, p: str = "p", by: Sequence[str] = (), clamp: bool = False) -> DataFrame:
    return df.groupBy(*by).agg(*kpi_columns(F.col(p), clamp))


def classification_metrics(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    """Confusion counts and threshold metrics in one pass; a zero denominator gives 0."""
    guess, truth = F.col(p) >= threshold, F.col(y) == 1
    counts = df.agg(
        F.count_if(~guess & ~truth).alias("tn"),
        F.count_if(guess & ~truth).alias("fp"),
        F.count_if(~guess & truth).alias("fn"),
        F.count_if(guess & truth).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        "tn",
        "fp",
        "fn",
        "tp",
        F.lit(float(threshold)).alias("threshold"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tn, tn + fp).alias("specificity"),
        ((ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2).alias("balanced_accuracy"),
    )


def base_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Brier score, positives, size, base rate and expected count."""
    return df.agg(
        F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("brier"),
        F.sum(y).alias("positives"),
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("base_rate"),
        F.sum(p).alias("expected"),
    )


def class_balance(df: DataFrame, y: str = "y") -> DataFrame:
    """Positive and negative counts, and the weight that makes the positives count as much."""
    pos, neg = F.count_if(F.col(y) == 1), F.count_if(F.col(y) == 0)
    return df.agg(pos.alias("pos"), neg.alias("neg")).withColumn(
        "positive_weight", F.greatest(F.col("neg") / F.greatest(F.col("pos"), F.lit(1)), F.lit(1.0))
    )


def count_scalar(df: DataFrame, y: str = "y", p: str = "p", low: float = 0.6, high: float = 1.4) -> DataFrame:
    """One row: actual over expected count, limited to [low, high]; 1 when nothing is expected."""
    sums = df.agg(F.sum(y).alias("_actual"), F.sum(p).alias("_expected"))
    factor = clip(F.col("_actual") / F.when(F.col("_expected") > 0, F.col("_expected")), low, high)
    return sums.select(F.when(F.col("_expected") > 0, factor).otherwise(F.lit(1.0)).alias("scalar"))


def apply_count_scalar(df: DataFrame, scalar: DataFrame, p: str = "p", name: str = "p_adjusted") -> DataFrame:
    """Scaled probabilities limited to [0, 1]; ``scalar`` is the row of :func:`count_scalar`."""
    return df.withColumn(name, clip(F.col(p) * scalar.scalar(), 0.0, 1.0))


def projection(df: DataFrame, done: Column, p: str = "p") -> DataFrame:
    """Already done plus expected among the rest."""
    finished = F.count_if(done)
    pending = F.coalesce(F.sum(F.when(~done, F.col(p))), F.lit(0.0))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        finished.alias("done"),
        pending.alias("expected_more"),
        (finished + pending).alias("projected"),
    )


def bin_table(df: DataFrame, y: str = "y", p: str = "p", bins: int = 10) -> DataFrame:
    """Equal-count score bins with expected and actual positives, best bin first."""
    edges = ordered.quantile_edges(df, p, bins)
    return (
        df.where(F.col(p).isNotNull())
        .withColumn("bin", ordered.bin_by_edges(F.col(p), edges))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(p).alias("expected"),
            F.sum(y).alias("actual"),
            F.avg(p).alias("mean_p"),
        )
        .withColumn("error", F.col("expected") - F.col("actual"))
        .orderBy(F.desc("bin"))
    )


def reliability_curve(df: DataFrame, y: str = "y", p: str = "p", bins: int = 10) -> DataFrame:
    """Mean prediction and observed rate per quantile bin (bins are [low, high), the last one closed)."""
    edges = ordered.quantile_edges(df, p, bins)
    inner = [F.when(F.col(p) >= F.lit(edge), 1).otherwise(0) for edge in edges[1:-1]]
    number = sum(inner, F.lit(0))
    return (
        df.where(F.col(p).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.avg(p).alias("predicted"), F.avg(y).alias("observed"))
    )
