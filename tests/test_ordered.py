"""Order-dependent operators against brute force, with ties, nulls and a key that holds a third of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from verdin.operators import curves, kpi, ordered, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame(
        {
            "id": range(n),
            "key": ["hot" if i % 3 == 0 else f"k{rng.integers(0, 40)}" for i in range(n)],
            "value": rng.integers(0, 50, n).astype(float),
            "y": rng.integers(0, 2, n),
        }
    )
    pdf.loc[pdf.id % 17 == 0, "key"] = None
    return pdf, spark.createDataFrame(pdf).cache()


def test_global_running_totals(skewed):
    pdf, df = skewed
    got = ordered.running_totals(df, [F.asc("value"), F.asc("id")], {"upto": F.col("y")}).toPandas()
    want = pdf.sort_values(["value", "id"]).assign(upto=lambda d: d.y.cumsum())
    merged = got.merge(want[["id", "upto"]], on="id")
    assert len(merged) == len(pdf) and (merged.upto_x == merged.upto_y).all()


def test_group_row_numbers_with_hot_and_null_key(skewed):
    pdf, df = skewed
    got = ordered.row_number(df, [F.desc("value"), F.asc("id")], "n", ["key"]).toPandas()
    want = pdf.sort_values(["value", "id"], ascending=[False, True])
    want["n"] = want.groupby("key", dropna=False).cumcount() + 1
    merged = got.merge(want[["id", "n"]], on="id")
    assert (merged.n_x == merged.n_y).all()


def test_group_quantiles(skewed):
    pdf, df = skewed
    got = ordered.quantiles(df, "value", {"a": 0.5, "b": 0.75, "c": 0.1}, ["key"]).toPandas().set_index("key")
    for key, part in pdf.groupby("key"):
        for name, q in (("a", 0.5), ("b", 0.75), ("c", 0.1)):
            assert got.loc[key, name] == pytest.approx(part.value.quantile(q))


def test_quantiles_of_continuous_values_and_nulls(spark):
    values = [None, *np.random.default_rng(1).normal(size=501).tolist()]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = ordered.quantiles(df, "v", {"m": 0.5, "q": 0.333}).first()
    assert got["m"] == pytest.approx(np.quantile(values[1:], 0.5))
    assert got["q"] == pytest.approx(np.quantile(values[1:], 0.333))


def test_bins_match_value_based_edges(skewed):
    pdf, df = skewed
    edges = ordered.quantile_edges(df, "value", 10)
    got = df.select("id", ordered.bin_by_edges(F.col("value"), edges).alias("bin")).toPandas()
    want = pd.qcut(pdf.value, 10, labels=False, duplicates="drop")
    assert (got.sort_values("id").bin.values == want.values).all()


@pytest.mark.parametrize("m", [0, 1, 40, 2999, 3000, 9999])
def test_top_m_threshold(skewed, m):
    pdf, df = skewed
    p = pdf.value.values
    want = p.min() if m <= 0 or m >= len(p) else np.sort(p)[-m]
    flagged = ranking.flag_top(df, m, "value")
    assert flagged.select("threshold").first()[0] == want
    assert flagged.where("selected = 1").count() == int((p >= want).sum())


def test_pending_worklist_leaves_done_rows_out(skewed):
    pdf, df = skewed
    rows = ranking.flag_top_pending(df, 10, F.col("y") == 1, "value").toPandas()
    assert len(rows) == int((pdf.y == 0).sum()) and rows.selected.sum() >= 10


def test_auc_and_average_precision_with_ties(skewed):
    pdf, df = skewed
    got = curves.ranking_metrics(df, "y", "value").first()
    pos, neg = pdf[pdf.y == 1].value.values, pdf[pdf.y == 0].value.values
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert got["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)))
    steps, tp, fp, ap = sorted(set(pdf.value), reverse=True), 0, 0, 0.0
    for s in steps:
        hits = int(((pdf.value == s) & (pdf.y == 1)).sum())
        tp, fp = tp + hits, fp + int(((pdf.value == s) & (pdf.y == 0)).sum())
        ap += hits / len(pos) * tp / (tp + fp)
    assert got["avg_precision"] == pytest.approx(ap)


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y INT, p DOUBLE")
    assert curves.ranking_metrics(df).first()["roc_auc"] is None


def test_time_folds_like_expanding_window(spark):
    df = spark.range(23).withColumn("period", F.col("id") % 4)
    got = ranking.time_folds(df, [F.asc("period"), F.asc("id")], 5).orderBy("period", "id").toPandas()
    size = 23 // 6
    want = [0] * (23 - 5 * size) + [k for k in range(1, 6) for _ in range(size)]
    assert got.fold.tolist() == want
    with pytest.raises(ValueError):
        ranking.time_folds(spark.range(3), [F.asc("id")], 5)


def test_split_is_stratified_and_whole(skewed):
    pdf, df = skewed
    parts = ranking.stratified_split(df, "y", "id", {"test": 0.2, "validation": 0.1, "train": 0.7}).toPandas()
    assert len(parts) == len(pdf)
    for label, group in parts.groupby("y"):
        n = len(group)
        assert (group.part == "test").sum() == int(n * 0.2 + 0.5)
        assert (group.part != "train").sum() == int(n * 0.3 + 0.5)


def test_kpi_block_clamps_and_handles_empty(spark):
    df = spark.createDataFrame([("a", 0.01), ("a", None), ("b", 1.5)], "s STRING, p DOUBLE")
    rows = {r["s"]: r for r in kpi.kpi_block(df, by=["s"], clamp=True).collect()}
    assert rows["a"]["n"] == 2 and rows["a"]["ci_low"] == 0.0
    assert rows["b"]["expected"] == 1.0 and rows["b"]["ci_high"] == 1.0
    empty = kpi.kpi_block(df.where("false")).first()
    assert empty["n"] == 0 and empty["rate"] is None


def test_count_scalar_limits(spark):
    def scalar(rows):
        return kpi.count_scalar(spark.createDataFrame(rows, "y INT, p DOUBLE")).first()["scalar"]

    assert scalar([(1, 0.1), (1, 0.1)]) == 1.4
    assert scalar([(0, 0.9)]) == 0.6
    assert scalar([(1, 0.0)]) == 1.0


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y INT, p DOUBLE")
    row = kpi.classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_control_table_keeps_null_segment(spark):
    df = spark.createDataFrame([(None, 1, 0.2), ("x", 0, 2.0)], "s STRING, y INT, p DOUBLE")
    rows = kpi.control_table(df, "s").collect()
    assert [(r["s"], r["expected"]) for r in rows] == [("x", 1.0), (None, 0.2)]
