"""Feature and model queries: encodings, imputations, weekly datasets, sequences, MLlib models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions.text import sentence_mark_count, word_count
from verdin.operators import curves, enrolment, features, isotonic, kpi, models, ranking
from verdin.plans.registry import query
from verdin.plans.relational import LABEL_SQL, labelled_enrolments
from verdin.plans.scoring import rounded
from verdin.session import pinned, read_table, scratch_path
from verdin.sources import staged

FIRST_WEEK = {"c_mktsegment": 1, "c_nationkey": 1, "c_acctbal": 3, "balance_band": 8, "late": 12}
BAND_SQL = "CASE WHEN c_acctbal > 5000 THEN 'top band' WHEN c_acctbal > 0 THEN 'mid' END"


def students(spark: SparkSession, folder: str) -> DataFrame:
    band = F.when(F.col("c_acctbal") > 5000, F.lit("top band")).when(F.col("c_acctbal") > 0, F.lit("mid"))
    return read_table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", band.alias("balance_band"),
        (F.col("c_nationkey") % 2).alias("late"), (F.col("c_acctbal") < 0).cast("int").alias("left_early"),
    )


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def one_hot_sql() -> str:
    segments = ", ".join(f"CAST(c_mktsegment = '{s}' AS INT) AS c_mktsegment_{s}" for s in SEGMENTS)
    return f"""{segments}, CAST(c_mktsegment IS NULL AS INT) AS c_mktsegment_nan"""


BAND_COLUMNS = f"""CAST(coalesce({BAND_SQL} = 'mid', false) AS INT) AS balance_band_mid,
    CAST(coalesce({BAND_SQL} = 'top band', false) AS INT) AS balance_band_top_band, CAST({BAND_SQL} IS NULL AS INT) AS balance_band_nan"""


@query("e4_one_hot", f"SELECT c_custkey, {one_hot_sql()}, {BAND_COLUMNS} FROM customer")
def one_hot(spark, folder):
    rows = students(spark, folder).select("c_custkey", "c_mktsegment", "balance_band")
    return features.one_hot(rows, ["c_mktsegment", "balance_band"])[0]


@query(
    "e5_availability",
    """SELECT event_type AS variable, CAST(unnest(range(min(week(ts)), 17)) AS INT) AS week FROM events GROUP BY event_type""",
)
def availability(spark, folder):
    """Which kind of event is known in which week: from the week of its first one on."""
    events = read_table(spark, folder, "events")
    first = events.groupBy(F.col("event_type").alias("variable")).agg(F.min(F.weekofyear("ts")).alias("first_week"))
    return features.availability(first, 16)


@query(
    "e6_weekly_table",
    f"""WITH c AS (SELECT *, CAST(c_acctbal < 0 AS INT) AS left_early, c_nationkey % 2 AS late FROM customer),
    e AS (SELECT c_custkey, left_early, late, c_nationkey, c_acctbal, {one_hot_sql()}, {BAND_COLUMNS} FROM c)
    SELECT c_custkey, left_early, w AS week, c_nationkey, CASE WHEN w >= 3 THEN c_acctbal END AS c_acctbal,
      {', '.join(f'c_mktsegment_{s}' for s in (*SEGMENTS, 'nan'))},
      {', '.join(f'CASE WHEN w >= 8 THEN balance_band_{b} END AS balance_band_{b}' for b in ('mid', 'top_band', 'nan'))},
      CASE WHEN w >= 12 THEN late END AS late FROM e, (VALUES (1), (3), (8), (12)) t(w)""",
)
def weekly_table(spark, folder):
    """The datasets of weeks 1, 3, 8 and 12 under each other; what a week does not know is null."""
    tables = features.weekly_tables(students(spark, folder), ["c_custkey", "left_early"], FIRST_WEEK, [1, 3, 8, 12])
    parts = [table.withColumn("week", F.lit(week)) for week, table in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


@query(
    "e7_sequence_table",
    f"""WITH c AS (SELECT *, CAST(c_acctbal < 0 AS INT) AS left_early, c_nationkey % 2 AS late FROM customer),
    e AS (SELECT c_custkey, left_early, late, c_nationkey, c_acctbal, {one_hot_sql()}, {BAND_COLUMNS} FROM c)
    SELECT c_custkey, left_early, CAST(w AS INT) AS week, c_nationkey, CASE WHEN w >= 3 THEN c_acctbal END AS c_acctbal,
      {', '.join(f'c_mktsegment_{s}' for s in (*SEGMENTS, 'nan'))},
      {', '.join(f'CASE WHEN w >= 8 THEN balance_band_{b} END AS balance_band_{b}' for b in ('mid', 'top_band', 'nan'))},
      CASE WHEN w >= 12 THEN late END AS late FROM e, range(1, 17) t(w)""",
)
def sequence_table(spark, folder):
    return features.sequence_table(students(spark, folder), ["c_custkey", "left_early"], FIRST_WEEK, 16)


@query(
    "e8_sequence_tensor",
    """WITH s AS (SELECT DISTINCT CAST(week(ts) AS INT) AS week FROM events), u AS (SELECT DISTINCT user_id FROM events),
    l AS (SELECT user_id, week(ts) AS week, max_by(value, event_id) AS value, max_by(CAST(props->>'$.k' AS DOUBLE), event_id) AS k FROM events GROUP BY 1, 2)
    SELECT u.user_id, CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY s.week) - 1 AS INT) AS place, round(l.value, 6) AS value, round(l.k, 6) AS k
    FROM u, s LEFT JOIN l ON l.user_id = u.user_id AND l.week = s.week""",
)
def sequence_tensor(spark, folder):
    rows = read_table(spark, folder, "events").select(
        "user_id", "event_id", F.weekofyear("ts").alias("week"), "value", F.get_json_object("props", "$.k").cast("double").alias("k")
    )
    tensor = features.sequence_tensor(rows, "user_id", "week", ["value", "k"], "event_id")
    steps = tensor.select("user_id", F.posexplode("tensor").alias("place", "step"))
    return rounded(steps.select("user_id", "place", F.get("step", F.lit(0)).alias("value"), F.get("step", F.lit(1)).alias("k")))


SPARSE_SQL = "sp AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v, CASE WHEN event_type <> 'click' THEN CAST(props->>'$.k' AS DOUBLE) END AS k, CASE WHEN value > 3 THEN event_type END AS kind FROM events)"


def sparse_events(spark: SparkSession, folder: str, *carried: Column) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return read_table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
        F.when(F.col("event_type") != "click", k).alias("k"),
        F.when(F.col("value") > 3, F.col("event_type")).alias("kind"),
        *carried,
    )


@query(
    "e9_impute_medians",
    f"WITH {SPARSE_SQL} SELECT event_id, round(coalesce(v, (SELECT quantile_cont(v, 0.5) FROM sp)), 6) AS v, round(coalesce(k, (SELECT quantile_cont(k, 0.5) FROM sp)), 6) AS k FROM sp",
)
def impute_medians(spark, folder):
    return rounded(features.impute_medians(sparse_events(spark, folder).select("event_id", "v", "k"), ["v", "k"]))


MODE_SQL = "(SELECT kind FROM sp WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, kind LIMIT 1)"


@query("e10_impute_modes", f"WITH {SPARSE_SQL} SELECT event_id, coalesce(kind, {MODE_SQL}) AS kind FROM sp")
def impute_modes(spark, folder):
    return features.impute_modes(sparse_events(spark, folder).select("event_id", "kind"), ["kind"])


@query(
    "a16_modes",
    f"""WITH {SPARSE_SQL}, c AS (SELECT 'kind' AS "column", kind AS mode, count(*) AS n FROM sp WHERE kind IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'type', event_type, count(*) FROM events GROUP BY 2)
    SELECT "column", mode, n FROM c QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, mode) = 1""",
)
def modes(spark, folder):
    rows = sparse_events(spark, folder, F.col("event_type").alias("type"))
    return features.modes(rows, ["kind", "type"])


@query(
    "e11_label_codes",
    """WITH c AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 25))
    SELECT p_partkey, CAST(coalesce(code, -1) AS INT) AS code, CAST(coalesce(n.code2, -1) AS INT) AS name_code FROM part LEFT JOIN c USING (p_type)
    LEFT JOIN (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code2 FROM (SELECT DISTINCT p_name FROM part WHERE p_size <= 5)) n USING (p_name)""",
)
def label_codes(spark, folder):
    part = read_table(spark, folder, "part")
    known = features.label_codes(part.where("p_size <= 25"), "p_type")
    names = features.label_codes(part.where("p_size <= 5"), "p_name")
    coded = features.encode_labels(part.select("p_partkey", "p_type", "p_name"), "p_type", known, "code")
    return features.encode_labels(coded, "p_name", names, "name_code").select("p_partkey", "code", "name_code")


@query(
    "e13_standardise",
    f"""WITH {SPARSE_SQL}, m AS (SELECT avg(coalesce(v, 0)) AS mv, stddev_pop(coalesce(v, 0)) AS dv, avg(coalesce(k, 0)) AS mk, stddev_pop(coalesce(k, 0)) AS dk FROM sp)
    SELECT event_id, round((coalesce(v, 0) - mv) / dv, 6) AS v, round((coalesce(k, 0) - mk) / dk, 6) AS k FROM sp, m""",
)
def standardise(spark, folder):
    return rounded(features.standardise(sparse_events(spark, folder).select("event_id", "v", "k"), ["v", "k"], 0.0))


@query("w5_last_value", "SELECT user_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY 1")
def last_value(spark, folder):
    return ranking.last_value_per_key(read_table(spark, folder, "events"), "user_id", "event_type", "event_id")


@query(
    "w8_stratified_split",
    """WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY quality) AS n FROM labels)
    SELECT doc_id, CASE WHEN k <= round(n * 0.2) THEN 'test' WHEN k <= round(n * (0.2 + 0.1)) THEN 'validation' ELSE 'train' END AS part FROM r""",
)
def stratified_split(spark, folder):
    shares = {"test": 0.2, "validation": 0.1, "train": 0.7}
    return ranking.stratified_split(read_table(spark, folder, "labels"), "quality", "doc_id", shares).select("doc_id", "part")


@query(
    "w10_strongest_inputs",
    """WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(v) DESC, i DESC) AS k FROM x)
    SELECT vec_id, string_agg(printf('d%d (%.2f)', i, CAST(v AS DOUBLE)), ', ' ORDER BY k) AS strongest FROM r WHERE k <= 3 GROUP BY 1""",
)
def strongest_inputs(spark, folder):
    return read_table(spark, folder, "embeddings").select("vec_id", models.strongest(F.col("embedding")).alias("strongest"))



@query(
    "e20_linear_attribution",
    """SELECT vec_id, CAST(len(embedding) AS INT) AS inputs, true AS adds_up FROM embeddings""",
)
def linear_attribution(spark, folder):
    """Attributions of a fitted linear model: with the mean log-odds they add up to each row's log-odds."""
    rows = read_table(spark, folder, "embeddings").select("vec_id", "embedding", (F.col("label") % 2).cast("double").alias("label"))
    fitted = models.linear_on_arrays(rows, "embedding", "label")
    explained = models.linear_attribution(fitted.scored, "embedding", fitted.coefficients)
    centre = fitted.scored.agg(F.avg("log_odds")).scalar()
    total = F.aggregate("attribution", F.lit(0.0), lambda done, x: done + x)
    return explained.select("vec_id", F.size("attribution").alias("inputs"), (F.abs(total + centre - F.col("log_odds")) < 1e-6).alias("adds_up"))


@query(
    "w11_impute_by_frequency",
    """WITH p AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_type END AS kind FROM part),
    c AS (SELECT kind AS v, count(*) AS n FROM p WHERE kind IS NOT NULL GROUP BY 1),
    s AS (SELECT v, n, sum(n) OVER (ORDER BY n DESC, v) AS upto, sum(n) OVER () AS total FROM c)
    SELECT p_partkey, coalesce(kind, v) AS kind FROM p LEFT JOIN s ON kind IS NULL
      AND CAST(('0x' || md5('42:' || p_partkey)[:8]) AS BIGINT) % 1048576 BETWEEN floor((upto - n) * 1048576 / total) AND floor(upto * 1048576 / total) - 1""",
)
def impute_by_frequency(spark, folder):
    part = read_table(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_type")).alias("kind"))
    return features.impute_by_frequency(part, "kind", "p_partkey")


# ---------------------------------------------------------------- models on labelled documents
FEATURES = ["n_chars", "words", "marks", "lang", "source"]


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with counts of their text; written once, because fits read it many times."""
    documents = read_table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        word_count(F.col("text")).cast("double").alias("words"), sentence_mark_count(F.col("text")).cast("double").alias("marks"),
    )
    return pinned(documents.join(read_table(spark, folder, "labels"), "doc_id"))


SMALL_TREES = {"maxIter": 5, "maxDepth": 3}
LABELLED = "d AS (SELECT * FROM documents JOIN labels USING (doc_id))"


def probable(*columns: str) -> Column:
    """Whether scores are probabilities; the twins can state that, not the scores themselves."""
    fine = F.lit(True)
    for column in columns:
        fine = fine & F.coalesce(F.col(column).between(0.0, 1.0), F.lit(False))
    return fine.alias("probable")


def informative(scored: DataFrame, label: str, p: str = "p") -> Column:
    """Whether scores tell the classes apart better than one constant score would."""
    return F.lit(curves.ranking_metrics(scored, label, p).first()["roc_auc"] > 0.55).alias("informative")


def boosted_scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return pinned(models.score(models.fit(rows, FEATURES, "quality", "boosted", **SMALL_TREES), rows))


@query("e14_boosted_model", f"WITH {LABELLED} SELECT doc_id, CAST(quality AS BIGINT) AS quality, true AS probable, true AS informative FROM d")
def boosted_model(spark, folder):
    scored = boosted_scored(spark, folder)
    return scored.select("doc_id", F.col("quality").cast("bigint").alias("quality"), probable("p"), informative(scored, "quality"))


@query("e14_boosted_scores")
def boosted_scores(spark, folder):
    """The scores themselves; SQL cannot fit the model."""
    return boosted_scored(spark, folder).select("doc_id", "quality", "p")


@query("e12_e14_forest_on_sparse_columns", f"WITH {LABELLED} SELECT doc_id, CAST(quality AS BIGINT) AS quality, true AS probable, true AS informative FROM d")
def forest_on_sparse_columns(spark, folder):
    rows = labelled_documents(spark, folder)
    model = models.fit(rows, FEATURES, "quality", "random_forest", sparse=True, numTrees=10, maxDepth=4)
    scored = pinned(models.score(model, rows))
    return scored.select("doc_id", F.col("quality").cast("bigint").alias("quality"), probable("p"), informative(scored, "quality"))


def tree_attributed(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return models.tree_attributions(models.fit(rows, FEATURES, "quality", "boosted", **SMALL_TREES), rows)


@query("e20_w10_tree_attributions", f"WITH {LABELLED} SELECT doc_id, true AS adds_up, CAST(3 AS BIGINT) AS named FROM d")
def tree_attributions(spark, folder):
    """Shapley values of every labelled document; that they add up to the model's margin is a fact SQL can state."""
    total = F.col("base") + F.aggregate("attribution", F.lit(0.0), lambda a, b: a + b)
    named = F.size(F.split("strongest", ", ")).cast("bigint").alias("named")
    return tree_attributed(spark, folder).select("doc_id", (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up"), named)


@query("e20_w10_attribution_values")
def attribution_values(spark, folder):
    return tree_attributed(spark, folder).select("doc_id", "margin", "base", "attribution", "strongest")


def searched(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    grid = {"maxDepth": [2, 3, 4, 5, 6], "numTrees": [3, 5, 8, 12, 16]}
    fitted, chosen = models.random_search(rows, FEATURES, "quality", "random_forest", grid, draws=20, parallelism=4)
    return models.search_table(spark, fitted, chosen)


@query("e15_search_table")
def search_table(spark, folder):
    """The drawn settings and their mean AUC."""
    return searched(spark, folder)


@query("e15_random_search", "SELECT CAST(range AS INT) AS draw, true AS probable FROM range(20) WHERE (SELECT count(*) FROM labels) > 0")
def random_search(spark, folder):
    return searched(spark, folder).select("draw", probable("auc"))


def _out_of_fold(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return pinned(models.out_of_fold(rows, FEATURES, "quality", [F.asc("doc_id")], 5, **SMALL_TREES))


FOLDS_SQL = f"""WITH {LABELLED}, r AS (SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM d),
    f AS (SELECT doc_id, quality, CAST((i - (n - 5 * (n // 6))) // (n // 6) + 1 AS INT) AS fold FROM r WHERE i >= n - 5 * (n // 6))"""


@query("e16_platt_on_out_of_fold", f"{FOLDS_SQL} SELECT doc_id, fold, true AS probable FROM f")
def platt_on_out_of_fold(spark, folder):
    scored = _out_of_fold(spark, folder)
    return models.apply_platt(models.fit_platt(scored, "quality"), scored).select("doc_id", "fold", probable("p", "p_calibrated"))


@query("e17_isotonic", f"{FOLDS_SQL} SELECT doc_id, true AS probable FROM f")
def isotonic_on_out_of_fold(spark, folder):
    scored = _out_of_fold(spark, folder)
    return isotonic.apply_isotonic(isotonic.isotonic_pools(scored, "quality"), scored).select("doc_id", probable("p", "p_calibrated"))


@query("e16_e17_calibrated_scores")
def calibrated_scores(spark, folder):
    """Out-of-fold scores beside both calibrations."""
    scored = _out_of_fold(spark, folder)
    platt = models.apply_platt(models.fit_platt(scored, "quality"), scored, name="p_platt")
    both = isotonic.apply_isotonic(isotonic.isotonic_pools(scored, "quality"), platt, name="p_isotonic")
    return both.select("doc_id", "fold", "quality", "p", "p_platt", "p_isotonic")


@query("e18_batch_score", f"WITH {LABELLED} SELECT count(*) AS n, true AS enough, true AS best_first, true AS probable FROM d")
def batch_score(spark, folder):
    rows = labelled_documents(spark, folder)
    model = models.fit(rows, FEATURES, "quality", "boosted", **SMALL_TREES)
    scored = pinned(models.score(model, rows))
    platt = models.fit_platt(scored, "quality")
    scalar = kpi.count_scalar(models.apply_platt(platt, scored), "quality", "p_calibrated").first()["scalar"]
    final = models.batch_score(rows, model, FEATURES, platt, scalar, 50)
    lowest, highest = F.min(F.when(F.col("selected") == 1, F.col("p"))), F.max(F.when(F.col("selected") == 0, F.col("p")))
    return final.withColumn("fine", probable("p_raw", "p_cal", "p")).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("selected") >= 50).alias("enough"),
        F.coalesce(lowest >= highest, F.lit(True)).alias("best_first"),
        F.bool_and("fine").alias("probable"),
    )


WEEKLY_FEATURES = {"n_chars": 0, "lang": 1, "words": 2, "marks": 3}


def weekly_auc_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    parts = pinned(ranking.stratified_split(rows, "quality", "doc_id", {"test": 0.3, "train": 0.7}))
    fitted = models.weekly_models(parts.where("part = 'train'"), WEEKLY_FEATURES, "quality", [0, 1, 2, 3], **SMALL_TREES)
    return models.weekly_auc(fitted, parts.where("part = 'test'"), "quality", WEEKLY_FEATURES)


@query("a33_e19_weekly_models", "SELECT CAST(range AS INT) AS week, CAST(range + 1 AS INT) AS features, true AS probable FROM range(4) WHERE (SELECT count(*) FROM labels) > 0")
def weekly_auc(spark, folder):
    return weekly_auc_rows(spark, folder).select(F.col("week").cast("int").alias("week"), F.col("features").cast("int").alias("features"), probable("roc_auc"))


@query("a33_weekly_auc_table")
def weekly_auc_table(spark, folder):
    """The AUC of each week's model on the test part."""
    return weekly_auc_rows(spark, folder)


def scored_by_week(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder).withColumn("week", (F.col("doc_id") % 4).cast("int"))
    fitted = models.weekly_models(rows, WEEKLY_FEATURES, "quality", [0, 1, 2, 3], **SMALL_TREES)
    return models.score_by_week(fitted, rows, "week").select("doc_id", "week", "quality", "p")


@query("e19_score_by_week", f"WITH {LABELLED} SELECT doc_id, CAST(doc_id % 4 AS INT) AS week, true AS probable, true AS informative FROM d")
def score_by_week(spark, folder):
    scored = pinned(scored_by_week(spark, folder))
    return scored.select("doc_id", "week", probable("p"), informative(scored, "quality"))


@query("e19_scores_by_week")
def scores_by_week(spark, folder):
    return scored_by_week(spark, folder)


def importances(spark: SparkSession, folder: str) -> DataFrame:
    model = models.fit(labelled_documents(spark, folder), FEATURES, "quality", "random_forest", numTrees=10, maxDepth=4)
    return models.importance_table(spark, model)


@query("a32_importance", "SELECT CAST(5 AS BIGINT) AS inputs, true AS adds_up, true AS falling FROM labels LIMIT 1")
def importance(spark, folder):
    # one number per input; partials of an aggregate arrive in any order, so each number carries its place
    listed = F.array_sort(F.collect_list(F.struct("place", "percent")))["percent"]
    return importances(spark, folder).withColumn("place", F.monotonically_increasing_id()).agg(
        F.count(F.lit(1)).alias("inputs"),
        (F.abs(F.sum("percent") - 100) < 1e-6).alias("adds_up"),
        (F.sort_array(listed, asc=False) == listed).alias("falling"),
    )


@query("a32_importance_table")
def importance_table(spark, folder):
    return importances(spark, folder)


@query("e21_tone_confidence", "SELECT doc_id, true AS confident FROM documents")
def tone_confidence(spark, folder):
    rows = read_table(spark, folder, "documents").select("doc_id", "text")
    said = models.tone_confidence(models.tone_model(spark), rows, "text")
    return said.select("doc_id", (F.col("confidence").between(0.5, 1.0) & F.col("tone").isin("positivo", "negativo")).alias("confident"))


@query("model_ranking_metrics", f"{FOLDS_SQL} SELECT true AS probable FROM f LIMIT 1")
def model_ranking_metrics(spark, folder):
    """Ranking metrics of calibrated out-of-fold scores."""
    scored = _out_of_fold(spark, folder)
    calibrated = models.apply_platt(models.fit_platt(scored, "quality"), scored)
    metrics = curves.ranking_metrics(calibrated, "quality", "p_calibrated")
    return metrics.select(probable(*[c for c, kind in metrics.dtypes if kind == "double"]))


# ---------------------------------------------------------------- re-enrolment scoring
ENROLMENT_FEATURES = ["o_totalprice", "o_orderpriority", "o_orderstatus", "month"]


def enrolment_scoring(spark: SparkSession, folder: str) -> enrolment.Scoring:
    rows = labelled_enrolments(spark, folder).withColumn("month", F.month("o_orderdate").cast("double"))
    needed = rows.select("o_orderkey", "o_custkey", "period_order", "y", *ENROLMENT_FEATURES)
    order = [F.asc("period_order"), F.asc("o_custkey"), F.asc("o_orderkey")]
    return enrolment.score_enrolments(needed, ENROLMENT_FEATURES, order, **SMALL_TREES)


@query(
    "evaluate_enrolments",
    f"""WITH {LABEL_SQL} SELECT o_orderpriority AS program, count(*) AS n, CAST(sum(y) AS BIGINT) AS actual, true AS consistent
        FROM lab WHERE ord = (SELECT max(ord) FROM lab) GROUP BY 1""",
)
def evaluate_enrolments(spark, folder):
    """Control table of the last period; scores depend on the model, so their consistency is reported."""
    run = enrolment_scoring(spark, folder)
    close = F.abs(F.col("expected") - F.col("actual") - F.col("error")) < 1e-6
    fine = (F.col("expected") >= 0) & (F.col("expected") <= F.col("n")) & close & F.lit(0.6 <= run.scalar <= 1.4)
    return run.control("o_orderpriority").select(
        F.col("o_orderpriority").alias("program"), "n", F.col("actual").cast("bigint").alias("actual"), fine.alias("consistent")
    )


@query(
    "enrolment_report",
    f"""WITH {LABEL_SQL}, v AS (SELECT *, ord = (SELECT max(ord) FROM lab) AS last FROM lab)
    SELECT count(*) FILTER (NOT last) AS n_train, count(*) FILTER (last) AS n_valid, CAST(sum(y) FILTER (last) AS BIGINT) AS positives,
      true AS adjusted_is_close FROM v""",
)
def enrolment_report(spark, folder):
    """The figures of the run, written as JSON and read back."""
    run = enrolment_scoring(spark, folder)
    path = scratch_path(spark, "enrolment-report")
    staged.write_report(enrolment.report_row(spark, run.report), path)
    row = staged.read_report(spark, path, ", ".join(f"{k} DOUBLE" for k in run.report))
    inside = F.col("scalar").between(0.6, 1.4)
    nearer = F.abs(F.col("adjusted_expected") - F.col("adjusted_positives")) <= F.abs(F.col("platt_expected") - F.col("platt_positives")) + 1e-6
    return row.select(
        F.col("n_train").cast("bigint").alias("n_train"), F.col("n_valid").cast("bigint").alias("n_valid"),
        F.col("raw_positives").cast("bigint").alias("positives"), (inside & nearer).alias("adjusted_is_close"),
    )
