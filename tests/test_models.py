"""Models and streams: ranges, whole results and restart."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from verdin.functions.numbers import logit
from verdin.operators import enrolment, isotonic, models
from verdin.session import scratch_path


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    rows = [(i, float(v), "ab"[i % 2], int(v + rng.normal() * 0.5 > 0)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id INT, x DOUBLE, c STRING, y INT").cache()


def test_fit_and_unknown_category(data):
    model = models.fit(data, ["x", "c"], "y", "rf", sparse=True, numTrees=5, maxDepth=3)
    scored = models.score(model, data.withColumn("c", F.lit("new")))
    low, high = scored.agg(F.min("p"), F.max("p")).first()
    assert 0 <= low < high <= 1
    with pytest.raises(ValueError):
        models.build("nothing")
    with pytest.raises(ValueError):
        models.fit(data, ["absent"], "y")


@pytest.mark.parametrize("name,options", [("rf", {"numTrees": 3, "maxDepth": 2}), ("linear", {}), ("gbt", {"maxIter": 2})])
def test_models_score_in_a_session_that_observed_a_table(data, name, options):
    data.observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    scored = models.score(models.fit(data, ["x", "c"], "y", name, **options), data)
    assert scored.where("p BETWEEN 0 AND 1").count() == 400
    fitted, chosen = models.random_search(data, ["x", "c"], "y", name, {"seed": [1], "maxDepth": [2]} if name == "rf" else {"maxIter": [2]}, draws=1)
    assert len(fitted.avgMetrics) == len(chosen) == 1 and models.score(fitted.bestModel, data).count() == 400


def test_linear_model_on_arrays_in_a_session_that_observed_a_table(data):
    data.observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    rows = data.select("id", F.array("x").alias("v"), "y")
    assert models.linear_on_arrays(rows, "v", "y").scored.where("log_odds IS NOT NULL").count() == 400


def test_out_of_fold_scores_and_calibration(data):
    scored = models.out_of_fold(data, ["x"], "y", [F.asc("id")], 3, "gbt", maxIter=3, maxDepth=2).cache()
    assert scored.count() == 300 and scored.select("id").distinct().count() == 300
    whole = models.out_of_fold(data, ["x"], "y", [F.asc("id")], 3, "gbt", include_unscored=True, maxIter=3, maxDepth=2)
    assert whole.count() == 400
    platt = models.apply_platt(models.fit_platt(scored, "y"), scored)
    assert abs(platt.agg(F.avg("p_calibrated")).first()[0] - scored.agg(F.avg("y")).first()[0]) < 0.02
    iso = isotonic.apply_isotonic(isotonic.isotonic_pools(scored, "y"), scored).agg(F.min("p_calibrated"), F.max("p_calibrated")).first()
    assert 0 <= iso[0] <= iso[1] <= 1


def test_batch_score_flags_at_least_m(data):
    model = models.fit(data, ["x", "c"], "y", "gbt", maxIter=3, maxDepth=2)
    platt = models.fit_platt(models.score(model, data), "y")
    scored = models.batch_score(data, model, ["x", "c"], platt, 1.1, 25)
    assert scored.count() == 400 and scored.where("selected = 1").count() >= 25


def test_tone_model_probability(spark):
    df = spark.createDataFrame([(1, "no me interesa"), (2, None)], "id INT, body STRING")
    got = models.tone_confidence(models.tone_model(spark), df, "body").collect()
    assert all(0.5 <= r["confidence"] <= 1 for r in got)


def test_importance_of_texts_as_columns(spark, data):
    model = models.fit(data, ["x", "c"], "y", "rf", sparse=True, numTrees=5, maxDepth=3)
    table = models.importance_table(spark, model).collect()
    assert {r.feature for r in table} == {"x", "c=a", "c=b"} and abs(sum(r.percent for r in table) - 100) < 1e-6


def test_weeks_without_a_model_keep_their_rows(data):
    weekly = data.withColumn("week", F.when(F.col("id") > 10, (F.col("id") % 3).cast("int")))
    fitted = models.weekly_models(weekly, {"x": 0}, "y", [0, 1], "rf", numTrees=3, maxDepth=2)
    scored = models.score_by_week(fitted, weekly, "week")
    assert scored.count() == 400
    assert scored.where("p IS NULL").count() == weekly.where("week IS NULL OR week = 2").count()


def test_scratch_is_below_the_checkpoint_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.sparkContext.getCheckpointDir())


def seen_rows(monkeypatch, kind):
    """Rows each fit of a classifier gets."""
    seen, own = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, rows: (seen.append(rows.count()), own(self, rows))[1])
    return seen


def row_wise(df, features, **options):
    """The boosted trees of all rows, without cells."""
    weighted = models.with_class_weight(df.withColumn("label", F.col("y").cast("double")), "y")
    return Pipeline(stages=[*models.encoder(df, features), models.boosted(**options).setWeightCol("weight")]).fit(weighted)


def test_boosted_trees_of_cells_are_those_of_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(3000):
        a, kind = int(rng.integers(0, 9)), [None, "k", "l", "m"][rng.integers(0, 4)]
        rows.append((k, None if k % 11 == 0 else float(a), kind, int(a + (kind == "k") * 3 + rng.normal() > 5)))
    few = spark.createDataFrame(rows, "id INT, a DOUBLE, kind STRING, y INT").cache()
    whole = row_wise(few, ["a", "kind"], maxIter=4, maxDepth=3)
    seen = seen_rows(monkeypatch, GBTClassifier)
    model = models.fit(few, ["a", "kind"], "y", maxIter=4, maxDepth=3)
    assert seen[0] <= 9 * 4 * 2
    want = {r.id: r.p for r in models.score(whole, few).collect()}
    got = {r.id: r.p for r in models.score(model, few).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(set(got.values())) > 4


def test_numbers_of_many_values_meet_in_bins_that_keep_a_frequent_value_apart(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(6000):
        low = float(rng.exponential()) if k % 20 == 0 else 0.0
        top = float(-rng.exponential()) if k % 20 == 1 else 0.0
        rows.append((k, low, top, float(rng.normal()), int(low > 0 or top < 0)))
    many = spark.createDataFrame(rows, "id INT, low DOUBLE, top DOUBLE, noise DOUBLE, y INT").cache()
    seen = seen_rows(monkeypatch, GBTClassifier)
    scored = models.score(models.fit(many, ["low", "top", "noise"], "y", maxIter=3, maxDepth=3), many)
    assert seen[0] < 6000 / 10
    worst, best = scored.agg(F.min(F.when(F.col("y") == 1, F.col("p"))), F.max(F.when(F.col("y") == 0, F.col("p")))).first()
    assert worst > 0.5 > best
    assert models._splits([0.0, 0.0, 2.0, math.inf]) == [-math.inf, 0.0, math.nextafter(0.0, 1), 2.0, math.inf]


def test_forests_and_drawn_rows_are_fitted_on_rows(data, monkeypatch):
    seen = seen_rows(monkeypatch, GBTClassifier)
    models.fit(data, ["c"], "y", "gbt", maxIter=2, subsamplingRate=0.5)
    models.fit(data, ["c"], "y", "gbt", maxIter=2, minInstancesPerNode=5)
    models.fit(data, ["c"], "y", "gbt", maxIter=2)
    assert seen == [400, 400, 4]


def test_platt_curve_of_counted_scores_is_that_of_rows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    scored = spark.createDataFrame([(float(p), int(rng.random() < p * p)) for p in rng.integers(1, 20, 4000) / 20], "p DOUBLE, y INT").cache()
    rows = scored.select(F.col("y").cast("double").alias("label"), array_to_vector(F.array(logit(F.col("p")))).alias("features"))
    whole = LogisticRegression(regParam=1 / 4000, elasticNetParam=0.0, standardization=False).fit(rows)
    seen = seen_rows(monkeypatch, LogisticRegression)
    platt = models.fit_platt(scored, "y")
    assert seen[0] <= 38
    assert abs(platt.intercept - whole.intercept) < 1e-5 and abs(platt.coefficients[0] - whole.coefficients[0]) < 1e-5


def test_enrolments_of_the_last_period_are_scored_whole(spark):
    rng = np.random.default_rng(8)
    rows = [(k, k % 7 + 1 if k % 50 else None, float(x), "ab"[k % 2], int(x + rng.normal() > 0)) for k, x in enumerate(rng.normal(size=3000))]
    students = spark.createDataFrame(rows, "id INT, period_order INT, x DOUBLE, kind STRING, y INT")
    run = enrolment.score_enrolments(students, ["x", "kind"], [F.asc("period_order"), F.asc("id")], m=25, maxIter=3, maxDepth=2)
    last = [r for r in rows if r[1] == 7]
    assert {r.id for r in run.scored.collect()} == {r[0] for r in last}
    assert run.report["n_train"] == sum(r[1] is not None for r in rows) - len(last) and run.report["n_valid"] == len(last)
    assert run.report["raw_positives"] == sum(r[4] for r in last) and run.report["adjusted_brier"] < 0.22
    assert run.scored.where("selected = 1").count() >= 25
    assert {r.kind: r.n for r in run.control("kind").collect()} == {k: sum(r[3] == k for r in last) for k in "ab"}


def test_enrolments_are_labelled_once_for_all_periods(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def placed(k):
        seen.add(1)
        return k % 4

    rows = spark.range(600).select("id", placed.asNondeterministic()("id").alias("period_order"), (F.col("id") % 9).cast("double").alias("x"), (F.col("id") % 9 > F.col("id") % 5).cast("int").alias("y"))
    run = enrolment.score_enrolments(rows, ["x"], [F.asc("period_order"), F.asc("id")], folds=2, m=5, maxIter=1, maxDepth=2)
    assert (run.report["n_train"], run.report["n_valid"]) == (450, 150)
    assert seen.value == 600


def test_out_of_fold_scores_beside_columns_that_parquet_does_not_hold(data):
    odd = data.withColumns({"wait": F.expr("make_interval(0, id)"), "none": F.lit(None)})
    scored = models.out_of_fold(odd, ["x"], "y", [F.asc("id")], 1, "gbt", maxIter=1, maxDepth=2)
    assert scored.columns == [*odd.columns, "fold", "p"]
    assert scored.where("string(wait) = string(make_interval(0, id)) AND none IS NULL").count() == 200
