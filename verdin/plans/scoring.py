"""Scored-row queries: control tables, KPI blocks, calibration tables, ranking metrics, worklists.

The score of an event is value / (value + 10), its outcome is "k at least 60" in
the props document, its segment is the event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions import numbers
from verdin.operators import curves, kpi, ordered, ranking
from verdin.plans.registry import query
from verdin.session import read_table

SCORED = """scored AS (
  SELECT event_id, user_id, ts, event_type AS segment, value / (value + 10.0) AS p,
         CASE WHEN CAST(props->>'$.k' AS BIGINT) >= 60 THEN 1 ELSE 0 END AS y
  FROM events)"""

LABELLED = """labelled AS (
  SELECT l.doc_id, d.n_chars / (d.n_chars + 2000.0) AS p, l.quality AS y, l.toxic
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    outcome = F.get_json_object("props", "$.k").cast("bigint") >= 60
    return read_table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.col("event_type").alias("segment"),
        (F.col("value") / (F.col("value") + 10.0)).alias("p"),
        F.when(outcome, 1).otherwise(0).alias("y"),
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    labels = read_table(spark, folder, "labels")
    documents = read_table(spark, folder, "documents").select("doc_id", "n_chars")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        (F.col("n_chars") / (F.col("n_chars") + 2000.0)).alias("p"),
        F.col("quality").alias("y"),
        "toxic",
    )


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """All double columns rounded, so that summation order does not show."""
    return df.select(
        [F.round(c, places).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


@query(
    "a7_control_table",
    f"""WITH {SCORED}, t AS (
      SELECT segment, count(*) AS n, sum(least(greatest(p, 0), 1)) AS expected, CAST(sum(y) AS BIGINT) AS actual
      FROM scored GROUP BY segment)
    SELECT segment, n, round(expected, 6) AS expected, actual, round(expected - actual, 6) AS error,
           round(abs(expected - actual), 6) AS abs_error FROM t""",
)
def control_table(spark, folder):
    return rounded(kpi.control_table(scored(spark, folder), "segment"))


@query(
    "o1_largest_errors",
    f"""WITH {SCORED}, t AS (
      SELECT segment, count(*) AS n, sum(least(greatest(p, 0), 1)) AS expected, CAST(sum(y) AS BIGINT) AS actual
      FROM scored GROUP BY segment)
    SELECT segment, n, round(expected, 6) AS expected, actual, round(expected - actual, 6) AS error,
           round(abs(expected - actual), 6) AS abs_error FROM t
    ORDER BY abs(expected - actual) DESC, segment LIMIT 3""",
)
def largest_errors(spark, folder):
    table = kpi.control_table(scored(spark, folder), "segment")
    return rounded(ranking.top_rows(table, [F.desc("abs_error"), F.asc("segment")], 3))


KPI_SQL = """count(*) AS n, round(sum(p), 6) AS expected,
  round({low}, 6) AS ci_low, round({high}, 6) AS ci_high, round(sum(p) / count(*), 6) AS rate,
  round({low} / count(*), 6) AS rate_low, round({high} / count(*), 6) AS rate_high"""
LOW = "(sum(p) - 1.96 * sqrt(sum(p * (1 - p))))"
HIGH = "(sum(p) + 1.96 * sqrt(sum(p * (1 - p))))"
PLAIN_KPI = KPI_SQL.format(low=LOW, high=HIGH)
CLAMPED_KPI = KPI_SQL.format(low=f"greatest(0.0, {LOW})", high=f"least(count(*), {HIGH})")


@query("a8_kpi_global", f"WITH {SCORED} SELECT {PLAIN_KPI} FROM scored")
def kpi_global(spark, folder):
    return rounded(kpi.kpi_block(scored(spark, folder)))


@query("a8_kpi_by_segment", f"WITH {SCORED} SELECT segment, {PLAIN_KPI} FROM scored GROUP BY segment")
def kpi_by_segment(spark, folder):
    return rounded(kpi.kpi_block(scored(spark, folder), by=["segment"]))


@query("a9_kpi_clamped", f"WITH {SCORED} SELECT user_id, {CLAMPED_KPI} FROM scored GROUP BY user_id")
def kpi_clamped(spark, folder):
    return rounded(kpi.kpi_block(scored(spark, folder), by=["user_id"], clamp=True))


@query(
    "x3_multi_value_group_function",
    f"WITH {SCORED} SELECT segment, y, {CLAMPED_KPI} FROM scored GROUP BY segment, y",
)
def multi_value_group_function(spark, folder):
    return rounded(scored(spark, folder).groupBy("segment", "y").agg(*kpi.kpi_columns(F.col("p"), clamp=True)))


@query(
    "a17_class_balance",
    """SELECT count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg,
       round(greatest(count(*) FILTER (quality = 0) / greatest(count(*) FILTER (quality = 1), 1), 1.0), 6)
       AS positive_weight FROM labels""",
)
def class_balance(spark, folder):
    return rounded(kpi.class_balance(read_table(spark, folder, "labels"), "quality"))


CONFUSION = """SELECT count(*) FILTER (p < {t} AND y = 0) AS tn, count(*) FILTER (p >= {t} AND y = 0) AS fp,
  count(*) FILTER (p < {t} AND y = 1) AS fn, count(*) FILTER (p >= {t} AND y = 1) AS tp FROM {source}"""
THRESHOLD_SQL = """SELECT tn, fp, fn, tp, CAST({t} AS DOUBLE) AS threshold,
  round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
  round(CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END, 6) AS specificity,
  round((CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END
       + CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END) / 2, 6) AS balanced_accuracy FROM c"""


@query(
    "a18_classification_metrics",
    f"WITH {SCORED}, c AS ({CONFUSION.format(t=0.5, source='scored')}) {THRESHOLD_SQL.format(t=0.5)}",
)
def classification_metrics(spark, folder):
    return rounded(kpi.classification_metrics(scored(spark, folder)))


@query(
    "a18_classification_metrics_labels",
    f"WITH {LABELLED}, c AS ({CONFUSION.format(t=0.4, source='labelled')}) {THRESHOLD_SQL.format(t=0.4)}",
)
def classification_metrics_labels(spark, folder):
    return rounded(kpi.classification_metrics(labelled(spark, folder), threshold=0.4))


def ranking_sql(source: str) -> str:
    return f"""pos AS (SELECT p, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM {source} GROUP BY p),
    run AS (SELECT p, np, nn, sum(np) OVER (ORDER BY p DESC) AS tp, sum(nn) OVER (ORDER BY p DESC) AS fp FROM pos)
    SELECT round(sum(nn * (tp - np / 2)) / (sum(np) * sum(nn)), 6) AS roc_auc,
           round(sum(np * (tp / (tp + fp))) / sum(np), 6) AS avg_precision FROM run"""


@query("a19_a21_ranking_metrics", f"WITH {SCORED}, {ranking_sql('scored')}")
def ranking_metrics(spark, folder):
    return rounded(curves.ranking_metrics(scored(spark, folder)))


@query("a19_a21_ranking_metrics_labels", f"WITH {LABELLED}, {ranking_sql('labelled')}")
def ranking_metrics_labels(spark, folder):
    return rounded(curves.ranking_metrics(labelled(spark, folder)))


@query(
    "a20_roc_points",
    f"""WITH {LABELLED},
    pos AS (SELECT p, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM labelled GROUP BY p),
    run AS (SELECT p, sum(np) OVER (ORDER BY p DESC) / sum(np) OVER () AS tpr,
                   sum(nn) OVER (ORDER BY p DESC) / sum(nn) OVER () AS fpr FROM pos)
    SELECT round(p, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM run
    UNION ALL SELECT NULL, 0.0, 0.0""",
)
def roc_points(spark, folder):
    return rounded(curves.roc_points(labelled(spark, folder)))


@query(
    "a22_base_metrics",
    f"""WITH {SCORED} SELECT round(avg((p - y) * (p - y)), 6) AS brier, CAST(sum(y) AS BIGINT) AS positives,
      count(*) AS n, round(avg(y), 6) AS base_rate, round(sum(p), 6) AS expected FROM scored""",
)
def base_metrics(spark, folder):
    return rounded(kpi.base_metrics(scored(spark, folder)))


@query(
    "a23_metrics_at_top",
    f"""WITH {SCORED}, r AS (SELECT y, row_number() OVER (ORDER BY p DESC, event_id) AS place FROM scored)
    SELECT round(avg(y) FILTER (place <= 250), 6) AS precision_at_m,
           round(sum(y) FILTER (place <= 250) / sum(y), 6) AS recall_at_m,
           round(avg(y) FILTER (place <= 250) / avg(y), 6) AS lift_at_m FROM r""",
)
def metrics_at_top(spark, folder):
    return rounded(curves.metrics_at_top(scored(spark, folder), 250, "event_id"))


@query(
    "a24_count_scalar",
    f"""WITH {SCORED}, s AS (SELECT CASE WHEN sum(p) > 0 THEN least(greatest(sum(y) / sum(p), 0.6), 1.4)
      ELSE 1.0 END AS f FROM scored)
    SELECT event_id, round(p, 6) AS p, round(least(greatest(p * f, 0), 1), 6) AS p_adjusted FROM scored, s""",
)
def count_scalar(spark, folder):
    rows = scored(spark, folder)
    return rounded(kpi.apply_count_scalar(rows, kpi.count_scalar(rows)).select("event_id", "p", "p_adjusted"))


EDGES = """edges AS (SELECT list_sort(list_distinct(quantile_cont(p, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1]))) AS e FROM scored)"""


@query(
    "a25_bin_table",
    f"""WITH {SCORED}, {EDGES}, b AS (
      SELECT p, y, len(list_filter(e[2:len(e) - 1], lambda x: x < p)) AS bin FROM scored, edges)
    SELECT CAST(bin AS INT) AS bin, count(*) AS n, round(sum(p), 6) AS expected, CAST(sum(y) AS BIGINT) AS actual,
           round(avg(p), 6) AS mean_p, round(sum(p) - sum(y), 6) AS error FROM b GROUP BY bin""",
)
def bin_table(spark, folder):
    return rounded(kpi.bin_table(scored(spark, folder)))


@query(
    "a26_reliability_curve",
    f"""WITH {SCORED}, {EDGES}, b AS (
      SELECT p, y, len(list_filter(e[2:len(e) - 1], lambda x: x <= p)) AS bin FROM scored, edges)
    SELECT CAST(bin AS INT) AS bin, round(avg(p), 6) AS predicted, round(avg(y), 6) AS observed FROM b GROUP BY bin""",
)
def reliability_curve(spark, folder):
    return rounded(kpi.reliability_curve(scored(spark, folder)))


@query(
    "w3_quantile_bins",
    f"""WITH {SCORED}, {EDGES}
    SELECT event_id, CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < p)) AS INT) AS bin FROM scored, edges""",
)
def quantile_bins(spark, folder):
    rows = scored(spark, folder)
    edges = ordered.quantile_edges(rows, "p", 10)
    return rows.select("event_id", ordered.bin_by_edges(F.col("p"), edges).alias("bin"))


@query(
    "a31_label_distribution",
    "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic",
)
def label_distribution(spark, folder):
    return read_table(spark, folder, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query(
    "w1_top_m_flag",
    f"""WITH {SCORED}, t AS (SELECT min(p) AS thr FROM (SELECT p FROM scored ORDER BY p DESC LIMIT 250))
    SELECT event_id, CAST(p >= thr AS INT) AS selected, round(thr, 6) AS threshold FROM scored, t""",
)
def top_m_flag(spark, folder):
    return rounded(ranking.flag_top(scored(spark, folder), 250).select("event_id", "selected", "threshold"))


@query(
    "w2_top_m_pending",
    f"""WITH {SCORED}, pend AS (SELECT * FROM scored WHERE segment <> 'purchase'),
    t AS (SELECT min(p) AS thr FROM (SELECT p FROM pend ORDER BY p DESC LIMIT 250))
    SELECT event_id, CAST(p >= thr AS INT) AS selected, round(thr, 6) AS threshold FROM pend, t""",
)
def top_m_pending(spark, folder):
    done = F.col("segment") == "purchase"
    flagged = ranking.flag_top_pending(scored(spark, folder), 250, done)
    return rounded(flagged.select("event_id", "selected", "threshold"))


@query(
    "m1_logit",
    f"""WITH {SCORED} SELECT event_id,
      round(ln(least(greatest(p, 1e-6), 1 - 1e-6) / (1 - least(greatest(p, 1e-6), 1 - 1e-6))), 6) AS logit
    FROM scored""",
)
def logit(spark, folder):
    return rounded(scored(spark, folder).select("event_id", numbers.logit(F.col("p")).alias("logit")))


@query("m2_round", f"WITH {SCORED} SELECT event_id, round(p, 3) AS p3 FROM scored")
def round_places(spark, folder):
    return scored(spark, folder).select("event_id", F.round("p", 3).alias("p3"))


@query(
    "o6_highest_risk",
    f"WITH {LABELLED} SELECT doc_id, round(p, 6) AS p FROM labelled ORDER BY p DESC, doc_id LIMIT 5",
)
def highest_risk(spark, folder):
    top = ranking.top_rows(labelled(spark, folder), [F.desc("p"), F.asc("doc_id")], 5)
    return rounded(top.select("doc_id", "p"))
