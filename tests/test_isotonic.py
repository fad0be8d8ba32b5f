"""Isotonic calibration against the textbook method and MLlib."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from verdin.operators import isotonic


def textbook(rows):
    """(score, label, weight) to (low, high, mean), equal scores first joined."""
    joined = {}
    for p, y, w in rows:
        total, weight = joined.get(p, (0.0, 0.0))
        joined[p] = (total + y * w, weight + w)
    pools = []
    for p in sorted(joined):
        pools.append([p, p, *joined[p]])
        while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] - 1e-12:
            _, high, total, weight = pools.pop()
            pools[-1][1:] = [high, pools[-1][2] + total, pools[-1][3] + weight]
    return [(low, high, total / weight) for low, high, total, weight in pools]


def table(spark, rows):
    return spark.createDataFrame([(float(p), float(y), float(w)) for p, y, w in rows], "p double, y double, w double")


@pytest.mark.parametrize("kind", ["noise", "falling", "rising", "ties", "steps"])
@pytest.mark.parametrize("ranges", [1, 7])
def test_pools_equal_the_textbook(spark, kind, ranges):
    rnd = random.Random(kind)
    rows = []
    for k in range(400):
        p = {"noise": rnd.random(), "falling": k / 400, "rising": k / 400, "ties": rnd.randrange(9) / 8, "steps": k // 40}[kind]
        y = {"noise": rnd.random() < p, "falling": k < 200, "rising": k, "ties": rnd.randrange(2), "steps": (k // 40) % 3}[kind]
        rows.append((p, y, rnd.randrange(1, 5)))
    got = isotonic.isotonic_pools(table(spark, rows), "y", weight="w", ranges=ranges).orderBy("low").collect()
    want = textbook(rows)
    assert [(r.low, r.high) for r in got] == [(low, high) for low, high, _ in want]
    assert np.allclose([r["mean"] for r in got], [mean for *_, mean in want], atol=1e-12)


def test_values_equal_those_of_the_library(spark):
    rnd = random.Random(5)
    rows = [(rnd.random(), 0, 1) for _ in range(500)]
    rows = [(p, rnd.random() < p, w) for p, _, w in rows]
    df = table(spark, rows)
    new = spark.createDataFrame([(k / 97 - 0.01,) for k in range(100)] + [(None,)], "p double")
    plain = IsotonicRegression(labelCol="y", featuresCol="p").fit(df)
    want = [None if r.p is None else r.prediction for r in plain.transform(new.na.fill(0.5)).orderBy("p").collect()]
    got = isotonic.apply_isotonic(isotonic.isotonic_pools(df, "y", ranges=5), new)
    assert got.where("p IS NULL").first().p_calibrated is None
    filled = isotonic.apply_isotonic(isotonic.isotonic_pools(df, "y", ranges=5), new.na.fill(0.5)).orderBy("p").collect()
    assert np.allclose([r.p_calibrated for r in filled], want, atol=1e-9)


def test_odd_tables(spark):
    none = table(spark, [(0.5, 1, 1)]).limit(0)
    assert isotonic.isotonic_pools(none, "y").count() == 0
    assert isotonic.apply_isotonic(isotonic.isotonic_pools(none, "y"), table(spark, [(0.5, 1, 1)])).first().p_calibrated is None
    one = isotonic.isotonic_pools(table(spark, [(0.5, 1, 1)]).withColumn("y", F.lit(1.0)), "y")
    assert [(r.low, r["mean"]) for r in one.collect()] == [(0.5, 1.0)]
