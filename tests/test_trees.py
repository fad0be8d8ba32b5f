"""Tree ensembles from their node tables: one pass for all weeks, Shapley values against all subsets."""

import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from verdin.operators import models, trees


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(600):
        a, b, c, d = rng.normal(size=4)
        kind = "klmnop"[k % 6]
        rows.append((k, float(a), None if k % 17 == 0 else float(b), float(round(c)), kind, "uv"[k % 2], float(d), int(a + (kind in "kmo") + 0.5 * b * c + rng.normal() > 0.4), k % 5))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, kind string, side string, d double, y int, week int").cache()


FEATURES = {"a": 0, "kind": 0, "b": 1, "c": 2, "side": 2, "d": 3}


@pytest.mark.parametrize("name,options", [("boosted", {"maxIter": 6, "maxDepth": 4}), ("rf", {"numTrees": 7, "maxDepth": 5})])
def test_weeks_are_scored_in_one_pass_like_their_models(data, name, options):
    fitted = models.weekly_models(data, FEATURES, "y", [0, 1, 2, 3], name, **options)
    scored = models.score_by_week(fitted, data, "week")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert scored.columns == [*data.columns, "p"] and "Union" not in plan and plan.count("InMemoryTableScan ") == 1
    got = {r.id: r.p for r in scored.collect()}
    assert {k for k, p in got.items() if p is None} == {r.id for r in data.where("week = 4").collect()}
    for week, model in fitted.items():
        for r in models.score(model, data.where(F.col("week") == week)).collect():
            assert abs(got[r.id] - r.p) < 1e-9
    assert len({round(p, 6) for p in got.values() if p is not None}) > 50


def brute(grown, x, size):
    """Shapley values over all subsets; a missing feature takes both turns by the share of cover."""

    def value(node, known):
        f = int(grown.feature[node])
        if f < 0:
            return grown.value[node]
        left, right = int(grown.left[node]), int(grown.right[node])
        if f in known:
            down = trees.turns_left(grown, np.array([node]), x[f : f + 1])[0]
            return value(left if down else right, known)
        share = grown.cover[left] / grown.cover[node]
        return share * value(left, known) + (1 - share) * value(right, known)

    def whole(known):
        return sum(value(root, known) for root in grown.roots[0])

    out = []
    for i in range(size):
        rest = [j for j in range(size) if j != i]
        total = 0.0
        for n in range(size):
            for chosen in itertools.combinations(rest, n):
                total += factorial(n) * factorial(size - n - 1) / factorial(size) * (whole({*chosen, i}) - whole(set(chosen)))
        out.append(total)
    return out, whole(set())


@pytest.mark.parametrize("name,options", [("boosted", {"maxIter": 5, "maxDepth": 4}), ("rf", {"numTrees": 4, "maxDepth": 5})])
def test_attributions_equal_all_subsets(spark, data, name, options):
    model = models.fit(data, list(FEATURES), "y", name, **options)
    rows = models.tree_attributions(model, data).collect()
    names = models._slots(model)
    assert all(abs(r.base + sum(r.attribution) - (2 * r.margin / 2)) < 1e-9 for r in rows)
    grown = trees.forest(spark, {0: model.stages[-1]})
    inputs = {r.id: np.array(r.features.toArray()) for r in model.transform(data).select("id", "features").collect()}
    for r in rows[::60]:
        want, base = brute(grown, inputs[r.id], len(names))
        assert np.allclose(r.attribution, want, atol=1e-9) and abs(r.base - base) < 1e-9
        largest = names[max(range(len(names)), key=lambda k: abs(r.attribution[k]))]
        assert r.strongest.startswith(f"{largest} (")


def test_search_shares_the_encoding_and_gives_the_same_scores(data, monkeypatch):
    grid = {"maxDepth": [2, 3, 4], "numTrees": [3, 5]}
    fits = []
    kept = models.encoder
    monkeypatch.setattr(models, "encoder", lambda *args, **options: fits.append(1) or kept(*args, **options))
    found, chosen = models.random_search(data, list(FEATURES), "y", "rf", grid, draws=4)
    assert len(fits) == 3  # two folds and the last fit
    monkeypatch.undo()
    weighted = models.with_class_weight(data.withColumn("label", F.col("y").cast("double")), "y")
    classifier = models.build("rf").setWeightCol("weight")
    maps = [{classifier.getParam(k): v for k, v in combo.items()} for combo in chosen]
    stages = [*models.encoder(data, list(FEATURES)), classifier]
    plain = CrossValidator(estimator=Pipeline(stages=stages), estimatorParamMaps=maps, evaluator=BinaryClassificationEvaluator(labelCol="label"), numFolds=2, seed=42)
    assert np.allclose(found.avgMetrics, plain.fit(weighted).avgMetrics, atol=1e-9)
    scores = {r.p for r in models.score(found.bestModel, data).collect()}
    assert len(scores) > 20 and max(found.avgMetrics) > 0.7
