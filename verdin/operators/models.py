"""Classifiers on Spark MLlib: pipelines, search, out-of-fold scores, calibration, weekly models, attributions."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, HashingTF, Imputer, OneHotEncoder, OneHotEncoderModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, Tokenizer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions.numbers import clip, logit, sigmoid
from verdin.operators import curves, ranking, trees
from verdin.operators.columns import feature_kinds, require
from verdin.session import pinned, scratch_path, stored

Builder = Callable[..., Estimator]


def boosted(**options) -> Estimator:
    return GBTClassifier(**{"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": 42} | options)


def forest(**options) -> Estimator:
    return RandomForestClassifier(**{"numTrees": 100, "maxDepth": 8, "seed": 42} | options)


def linear(**options) -> Estimator:
    return LogisticRegression(**{"maxIter": 50, "regParam": 1e-4} | options)


# one family of trees stands for the boosted libraries
MODELS: dict[str, Builder] = {
    "random_forest": forest, "rf": forest, "boosted": boosted, "gbt": boosted, "catboost": boosted, "cb": boosted,
    "lightgbm": boosted, "lgbm": boosted, "xgboost": boosted, "xgb": boosted, "linear": linear,
}


def build(name: str, **options) -> Estimator:
    if name.lower() not in MODELS:
        raise ValueError(f"unknown model {name}, one of {sorted(MODELS)}")
    return MODELS[name.lower()](**options)


def encoder(df: DataFrame, features: Sequence[str], sparse: bool = False) -> list[Estimator]:
    """Stages from raw columns to a feature vector.

    Numbers get their approximate median for nulls; texts become codes in
    text order, or 0/1 columns where unknown texts are all zero.
    """
    numeric, texts = feature_kinds(df, features)
    stages: list[Estimator] = []
    if numeric:
        filled = [f"_n_{c}" for c in numeric]
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=filled))
    coded = [f"_c_{c}" for c in texts]
    if texts:
        stages.append(StringIndexer(inputCols=list(texts), outputCols=coded, handleInvalid="keep", stringOrderType="alphabetAsc"))
    if texts and sparse:
        wide = [f"_o_{c}" for c in texts]
        # the slot kept for unknown values is the last one, and the last one is dropped
        stages.append(OneHotEncoder(inputCols=coded, outputCols=wide, dropLast=True))
        coded = wide
    inputs = [f"_n_{c}" for c in numeric] + coded
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Positives weigh negatives / positives, at least 1."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    weight = max(counts["neg"] / max(counts["pos"], 1), 1.0)
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))


def without_summary(model: Model) -> Model:
    """A fitted classifier without its training summary.

    A summary holds the session, which tasks cannot receive once any table was observed in it, and
    forests and linear models take theirs along with every row they score.
    """
    if not getattr(model, "hasSummary", False):
        return model
    bare = model.copy()  # a forest leaves the summary behind
    if bare.hasSummary:
        path = scratch_path(SparkSession.active(), "model")
        model.write().save(path)
        bare = type(model).load(path)
    return bare


def fit(df: DataFrame, features: Sequence[str], label: str, name: str = "boosted", sparse: bool = False, **options) -> PipelineModel:
    """Encoder and classifier fitted on all rows, positives and negatives weighing the same.

    Boosted trees see a number only by its bin, so rows of one cell (bins, texts and label) are
    added up first, and the many passes of the trees go over cells.
    """
    require(df, [*features, label])
    weighted = with_class_weight(df.withColumn("label", F.col(label).cast("double")), label)
    classifier = build(name, **options).setWeightCol("weight")
    stages, ready = encoder(df, features, sparse), []
    if adds_up(classifier):
        numeric, texts = feature_kinds(df, features)
        fills, stages = (stages[:1], stages[1:]) if numeric else ([], stages)
        ready = Pipeline(stages=fills).fit(weighted).stages
        bins = bucketizer(PipelineModel(ready).transform(weighted), [f"_n_{c}" for c in numeric], classifier.getMaxBins())
        ready = [*ready, bins] if bins else ready
        binned = dict(zip(bins.getInputCols(), bins.getOutputCols(), strict=True)) if bins else {}
        stages[-1].setInputCols([binned.get(c, c) for c in stages[-1].getInputCols()])
        weighted = cells(PipelineModel(ready).transform(weighted), [binned.get(f"_n_{c}", f"_n_{c}") for c in numeric], texts)
    fitted = Pipeline(stages=[*stages, classifier]).fit(weighted)
    return PipelineModel([*ready, *fitted.stages[:-1], without_summary(fitted.stages[-1])])


def adds_up(classifier: Estimator) -> bool:
    """Whether a classifier learns the same from a row as from its copies added up: no rows drawn or counted."""
    return isinstance(classifier, GBTClassifier) and classifier.getSubsamplingRate() == 1.0 and classifier.getMinInstancesPerNode() == 1


def bucketizer(df: DataFrame, columns: Sequence[str], bins: int) -> Bucketizer | None:
    """Bins of the columns with many values, at their quantiles over all rows; a value with a bin's share of rows has its own.

    Columns of about ``2 * bins`` values at most are left as they are.
    """
    if not columns:
        return None
    shares = [k / bins for k in range(1, bins)]
    found = df.agg(
        *[F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(F.col(c).cast("double"), shares, 1000).alias(f"_q{i}") for i, c in enumerate(columns)],
    ).first()
    splits = {c: _splits(found[f"_q{i}"]) for i, c in enumerate(columns) if found[f"_d{i}"] > 2 * bins}
    splits = {c: edges for c, edges in splits.items() if len(edges) > 2}
    if not splits:
        return None
    names = [c.replace("_n_", "_b_", 1) for c in splits]
    return Bucketizer(splitsArray=list(splits.values()), inputCols=list(splits), outputCols=names, handleInvalid="keep")


def _splits(quantiles: Sequence[float]) -> list[float]:
    """Bin edges: each quantile, and the number after it where it stands twice."""
    inner = {q for q in quantiles if math.isfinite(q)}
    inner |= {math.nextafter(q, math.inf) for q in inner if quantiles.count(q) > 1}
    return [-math.inf, *sorted(q for q in inner if math.isfinite(q)), math.inf]


def cells(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """The ``weight`` of all rows with the same inputs and ``label``, written once."""
    added = stored(df.groupBy("label", *numbers, *texts).agg(F.sum("weight").alias("weight")))
    # bins stay in their order; as categories of a text trees would mix them
    plain = {c: F.col(c).alias(c, metadata={"ml_attr": {"type": "numeric"}}) for c in numbers}
    return added.withColumns(plain)


def score(model: Model, df: DataFrame, name: str = "p") -> DataFrame:
    """Probability of the positive class next to the columns of ``df``."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


class Search(NamedTuple):
    """Mean score of each drawn setting, and the pipeline of the best one fitted on all rows."""

    avgMetrics: list[float]  # noqa: N815
    bestModel: PipelineModel  # noqa: N815


def random_search(
    df: DataFrame, features: Sequence[str], label: str, name: str, grid: Mapping[str, Sequence], draws: int = 20,
    folds: int = 2, seed: int = 42, parallelism: int = 2,
):
    """Cross-validated search over a random part of a grid by ROC-AUC: a ``Search`` and the drawn settings.

    Inputs are encoded once per fold, from its own training rows, and written; the fits of all
    settings share them. ``parallelism`` bounds the fits that run at once, and with them the memory.
    """
    weighted = pinned(with_class_weight(df.withColumn("label", F.col(label).cast("double")), label).withColumn("_draw", F.rand(seed)))
    classifier = build(name).setWeightCol("weight")
    evaluator = BinaryClassificationEvaluator(labelCol="label")
    combos = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    chosen = random.Random(seed).sample(combos, min(draws, len(combos)))
    maps = [{classifier.getParam(k): v for k, v in combo.items()} for combo in chosen]

    def encoded(rows: DataFrame) -> tuple[PipelineModel, Callable[[DataFrame], DataFrame]]:
        fitted = Pipeline(stages=encoder(df, features)).fit(rows)
        return fitted, lambda part: pinned(fitted.transform(part).select("features", "label", "weight"))

    totals = [0.0] * len(maps)
    for fold in range(folds):
        tested = (F.col("_draw") >= fold / folds) & (F.col("_draw") < (fold + 1) / folds)
        _, ready = encoded(weighted.where(~tested))
        train, test = ready(weighted.where(~tested)), ready(weighted.where(tested))
        with ThreadPool(parallelism) as pool:
            scores = pool.map(lambda one, train=train, test=test: evaluator.evaluate(without_summary(classifier.fit(train, one)).transform(test)), maps)
        totals = [total + score / folds for total, score in zip(totals, scores, strict=True)]
    fitted, ready = encoded(weighted)
    best = without_summary(classifier.fit(ready(weighted), maps[totals.index(max(totals))]))
    return Search(totals, PipelineModel([*fitted.stages, best])), chosen


def search_table(spark: SparkSession, fitted, chosen: Sequence[Mapping]) -> DataFrame:
    """One row per drawn setting with its mean AUC."""
    rows = [(i, str(dict(c)), float(a)) for i, (c, a) in enumerate(zip(chosen, fitted.avgMetrics, strict=True))]
    return spark.createDataFrame(rows, "draw INT, setting STRING, auc DOUBLE")


def out_of_fold(
    df: DataFrame, features: Sequence[str], label: str, order: Sequence[Column], folds: int = 5, name: str = "boosted",
    include_unscored: bool = False, **options,
) -> DataFrame:
    """Scores of each time fold by a model fitted on the rows before it, as column ``p``.

    Rows before the first fold have no score; they are left out, or kept with 0.
    """
    placed = stored(ranking.time_folds(df, order, folds))
    parts = []
    for fold in range(1, folds + 1):
        model = fit(placed.where(F.col("fold") < fold), features, label, name, **options)
        parts.append(score(model, placed.where(F.col("fold") == fold)))
    if include_unscored:
        parts.append(placed.where("fold = 0").withColumn("p", F.lit(0.0)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def fit_platt(scored: DataFrame, label: str, p: str = "p") -> Model:
    """Logistic curve on the log-odds of out-of-fold scores, with the usual unit penalty.

    Rows of one score and label are counted first: trees give few different scores.
    """
    counted = stored(scored.groupBy(F.col(label).cast("double").alias("label"), F.col(p).alias("_p")).agg(F.count(F.lit(1)).cast("double").alias("weight")))
    rows = counted.select("label", "weight", array_to_vector(F.array(logit(F.col("_p")))).alias("features"))
    penalty = 1.0 / max(counted.agg(F.sum("weight")).first()[0] or 0.0, 1.0)
    return LogisticRegression(weightCol="weight", regParam=penalty, elasticNetParam=0.0, standardization=False).fit(rows)


def apply_platt(model: Model, scored: DataFrame, p: str = "p", name: str = "p_calibrated") -> DataFrame:
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    return scored.withColumn(name, sigmoid(F.lit(intercept) + F.lit(slope) * logit(F.col(p))))


def batch_score(
    df: DataFrame, model: Model, features: Sequence[str], platt: Model, scalar: float, m: int
) -> DataFrame:
    """Raw, calibrated and adjusted probability, and the flag of the best ``m``."""
    require(df, features)
    calibrated = apply_platt(platt, score(model, df, "p_raw"), "p_raw", "p_cal")
    adjusted = calibrated.withColumn("p", clip(F.col("p_cal") * F.lit(scalar), 0.0, 1.0))
    return ranking.flag_top(pinned(adjusted), m)


class WeeklyModels(dict):
    """Pipelines by week that share one encoder; ``slots`` holds the places of each week's inputs in its vector."""

    encoder: PipelineModel
    slots: dict[int, list[int]]


def weekly_models(
    df: DataFrame, first_week: Mapping[str, int], label: str, weeks: Sequence[int], name: str = "boosted", **options
) -> WeeklyModels:
    """One model per week on the features known by then; all inputs are encoded once."""
    features = sorted(first_week, key=lambda f: (first_week[f], f))
    require(df, [*features, label])
    weighted = with_class_weight(df.withColumn("label", F.col(label).cast("double")), label)
    fitted = Pipeline(stages=encoder(df, features)).fit(weighted)
    ready = pinned(fitted.transform(weighted).select("features", "label", "weight"))
    names = _slots(fitted)
    found = WeeklyModels()
    found.encoder, found.slots = fitted, {}
    for week in weeks:
        found.slots[week] = [k for k, one in enumerate(names) if first_week[one] <= week]
        slicer = VectorSlicer(inputCol="features", outputCol="known", indices=found.slots[week])
        classifier = build(name, **options).setWeightCol("weight").setFeaturesCol("known")
        sliced = Pipeline(stages=[slicer, classifier]).fit(ready)
        found[week] = PipelineModel([*fitted.stages, sliced.stages[0], without_summary(sliced.stages[1])])
    return found


def weekly_auc(models: Mapping[int, Model], test: DataFrame, label: str, first_week: Mapping[str, int]) -> DataFrame:
    """One row per weekly model: features used and AUC on the test rows."""
    parts = [
        curves.ranking_metrics(score(model, test), label).select(
            F.lit(week).alias("week"),
            F.lit(sum(first <= week for first in first_week.values())).alias("features"),
            "roc_auc",
        )
        for week, model in models.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def score_by_week(models: WeeklyModels, df: DataFrame, week: str) -> DataFrame:
    """Each row scored by the tree model of its week, in one pass over ``df``; rows of weeks without a model have a null score."""
    grown = trees.forest(df.sparkSession, {w: model.stages[-1] for w, model in models.items()}, models.slots)
    ready = models.encoder.transform(df).withColumn("_inputs", vector_to_array("features"))
    return trees.score_by_key(ready, grown, week, "_inputs").select(*df.columns, "p")


def tree_attributions(model: PipelineModel, df: DataFrame, k: int = 3) -> DataFrame:
    """``df`` plus ``margin``, ``base``, ``attribution`` (one number per input) and ``strongest``, the ``k`` largest inputs by name.

    Exact Shapley values along the trees; ``base`` and the attributions add up to the margin.
    """
    grown = trees.forest(df.sparkSession, {0: model.stages[-1]})
    names = _slots(model)
    scored = model.transform(df).withColumn("_inputs", vector_to_array("features"))
    margin = F.get(vector_to_array("rawPrediction"), F.lit(1)) if grown.boosted[0] else F.get(vector_to_array("probability"), F.lit(1))
    listed = scored.withColumns({"margin": margin, "attribution": trees.attribution(grown, 0, F.col("_inputs"))})
    base = F.lit(trees.expected_margin(trees.paths(grown, 0)))
    return listed.select(*df.columns, "margin", base.alias("base"), "attribution", strongest(F.col("attribution"), k, names).alias("strongest"))


def _slots(model: PipelineModel) -> list[str]:
    """Names of the places of the feature vector: a column, or a column and a text where texts became 0/1 columns."""
    texts = {out: labels for s in model.stages if isinstance(s, StringIndexerModel) for out, labels in zip(s.getOutputCols(), s.labelsArray, strict=True)}
    wide = {out: texts[c] for s in model.stages if isinstance(s, OneHotEncoderModel) for c, out in zip(s.getInputCols(), s.getOutputCols(), strict=True)}
    columns = [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    chosen = [s.getIndices() for s in model.stages if isinstance(s, VectorSlicer)]
    names = [name for c in columns for name in ([f"{c.split('_', 2)[2]}={text}" for text in wide[c]] if c in wide else [c.split("_", 2)[2]])]
    return [names[k] for k in chosen[0]] if chosen else names


def importance_table(spark: SparkSession, model: PipelineModel, n: int = 10) -> DataFrame:
    """The ``n`` most important inputs of a tree model as percentages."""
    names = _slots(model)
    shares = model.stages[-1].featureImportances.toArray()
    total = float(shares.sum()) or 1.0
    rows = sorted(((f, float(v) / total * 100) for f, v in zip(names, shares, strict=True)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows[:n], "feature STRING, percent DOUBLE")


class LinearFit(NamedTuple):
    coefficients: list[float]
    scored: DataFrame


def linear_on_arrays(df: DataFrame, values: str, label: str) -> LinearFit:
    """Logistic model on an array column: its coefficients, and the rows with their ``log_odds``."""
    rows = df.withColumn("_features", array_to_vector(F.col(values).cast("array<double>")))
    model = LogisticRegression(featuresCol="_features", labelCol=label, rawPredictionCol="_raw", maxIter=50, regParam=1e-4).fit(rows)
    scored = without_summary(model).transform(rows).withColumn("log_odds", vector_to_array("_raw")[1])
    return LinearFit([float(c) for c in model.coefficients], scored.select(*df.columns, "log_odds"))


def linear_attribution(df: DataFrame, values: str, coefficients: Sequence[float]) -> DataFrame:
    """``df`` plus ``attribution``: coefficient times distance from the mean, per input.

    The means come from one aggregate with a row per input.
    """
    spread = df.select(F.posexplode(values).alias("place", "value"))
    means = {r["place"]: r["mean"] for r in spread.groupBy("place").agg(F.avg("value").alias("mean")).collect()}
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    centre = F.array(*[F.lit(float(means.get(i, 0.0))) for i in range(len(coefficients))])
    distance = F.zip_with(F.col(values).cast("array<double>"), centre, lambda x, m: x - m)
    return df.withColumn("attribution", F.zip_with(weights, distance, lambda c, d: c * d))


def strongest(values: Column, k: int = 3, names: Sequence[str] | None = None) -> Column:
    """The ``k`` largest inputs by absolute value as ``name (0.12)``, later inputs first among equals."""
    listed = F.array(*[F.lit(n) for n in names]) if names else None

    def entry(value: Column, place: Column) -> Column:
        number = value.cast("double")
        return F.struct(F.abs(number).alias("size"), place.alias("place"), number.alias("value"))

    def shown(item: Column) -> Column:
        name = F.concat(F.lit("d"), item["place"].cast("string")) if listed is None else F.get(listed, item["place"])
        return F.format_string("%s (%.2f)", name, item["value"])

    ordered = F.sort_array(F.transform(values, entry), asc=False)
    return F.array_join(F.transform(F.slice(ordered, 1, k), shown), ", ")


# fixed values: seed phrases of the tone classifier
SEED_PHRASES = (
    ("Perfecto, entonces quedamos así", "positivo"),
    ("Sí, me interesa el producto", "positivo"),
    ("Muchas gracias por su ayuda", "positivo"),
    ("No me interesa en este momento", "negativo"),
    ("Estoy inconforme con la atención", "negativo"),
)


def tone_model(spark: SparkSession, phrases: Sequence[tuple[str, str]] = SEED_PHRASES, features: int = 4096) -> PipelineModel:
    rows = [(text, 1.0 if tone == "positivo" else 0.0) for text, tone in phrases]
    seeds = spark.createDataFrame(rows, "text STRING, label DOUBLE")
    stages = [
        Tokenizer(inputCol="text", outputCol="_tokens"),
        HashingTF(inputCol="_tokens", outputCol="features", numFeatures=features, binary=True),
        NaiveBayes(modelType="bernoulli"),
    ]
    return Pipeline(stages=stages).fit(seeds)


def tone_confidence(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    """Probability of the likelier tone, and that tone."""
    named = df if text == "text" else df.withColumnRenamed(text, "text")
    scored = model.transform(named.withColumn("text", F.coalesce("text", F.lit(""))))
    best = F.array_max(vector_to_array("probability"))
    tone = F.when(F.col("prediction") == 1, F.lit("positivo")).otherwise(F.lit("negativo"))
    return scored.select(*[c for c in named.columns], F.round(best, 2).alias("confidence"), tone.alias("tone"))
