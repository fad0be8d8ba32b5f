"""Re-enrolment scoring: labelled enrolments to calibrated, count-adjusted scores of the last period, with control tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions.numbers import clip
from verdin.operators import kpi, models, ranking
from verdin.session import pinned, stored


@dataclass
class Scoring:
    """Fitted parts, the scored rows of the last period (``p_raw``, ``p_cal``, ``p``, ``selected``), and the run's figures."""

    model: Model
    platt: Model
    scalar: float
    scored: DataFrame
    report: dict[str, float]

    def control(self, segment: str, label: str = "y") -> DataFrame:
        """Expected against actual per segment of the scored rows."""
        return kpi.control_table(self.scored, segment, label, "p")


def score_enrolments(
    rows: DataFrame,
    features: Sequence[str],
    order: Sequence[Column],
    label: str = "y",
    period_order: str = "period_order",
    folds: int = 5,
    m: int = 250,
    name: str = "boosted",
    **options,
) -> Scoring:
    """Fit on all periods but the last, and score the last one.

    Time folds of the earlier periods give out-of-fold scores for the Platt
    curve; the model of all earlier rows scores the last period; one factor
    within [0.6, 1.4] makes expected and actual counts meet; the best ``m`` are
    flagged. Rows without a period order are left out. Only single rows of
    figures reach the driver.
    """
    earlier, last = ranking.split_last_period(stored(rows.where(F.col(period_order).isNotNull())), period_order)
    platt = models.fit_platt(models.out_of_fold(earlier, features, label, order, folds, name, **options), label)
    model = models.fit(earlier, features, label, name, **options)
    calibrated = pinned(models.apply_platt(platt, models.score(model, last, "p_raw"), "p_raw", "p_cal"))
    scalar = float(kpi.count_scalar(calibrated, label, "p_cal").first()["scalar"])
    adjusted = calibrated.withColumn("p", clip(F.col("p_cal") * F.lit(scalar), 0.0, 1.0))
    scored = pinned(ranking.flag_top(adjusted, m))
    report = {"scalar": scalar, "n_train": earlier.count(), "n_valid": scored.count(), "m": m}
    for kind, p in (("raw", "p_raw"), ("platt", "p_cal"), ("adjusted", "p")):
        report |= {f"{kind}_{k}": v for k, v in kpi.base_metrics(scored, label, p).first().asDict().items()}
    return Scoring(model, platt, scalar, scored, report)


def report_row(spark: SparkSession, report: Mapping[str, float]) -> DataFrame:
    """The run's figures as one row."""
    return spark.createDataFrame([tuple(float(v) for v in report.values())], ", ".join(f"{k} DOUBLE" for k in report))
