"""Tree ensembles as a table of nodes: scores of many models in one pass, and exact Shapley attributions.

MLlib saves an ensemble as one row per node. These rows, of one model or of one per week, are
laid out as arrays and broadcast; their number is bounded by trees times 2 ** (depth + 1),
whatever the size of the data. Rows then walk down level by level in numpy, each
through the trees of the model its key names, so a table is read once for any number of models.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.session import scratch_path


class Forest(NamedTuple):
    """Nodes of all models, trees one after another; a leaf has no feature (-1)."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    nominal: np.ndarray
    goes_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    roots: dict[int, list[int]]
    boosted: dict[int, bool]
    width: int


def node_table(spark: SparkSession, model: Model, slots: Sequence[int] | None = None) -> DataFrame:
    """One row per node of a boosted or random-forest classifier.

    ``value`` is what a leaf adds to the model's margin: the tree's weight times its prediction, or the
    share of positives over the number of trees. ``slots`` names the places of the
    model's inputs in a longer feature vector.
    """
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    places = F.array(*[F.lit(int(s)) for s in (range(model.numFeatures) if slots is None else slots)])
    node, split = "nodeData", "nodeData.split"
    stats = F.col(f"{node}.impurityStats")
    if isinstance(model, GBTClassificationModel):
        value = F.get(weights, F.col("treeID")) * F.col(f"{node}.prediction")
    else:
        value = F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, b: a + b) / F.lit(float(model.getNumTrees))
    leaf = F.col(f"{node}.leftChild") < 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col(f"{node}.id").alias("node"),
        F.col(f"{node}.leftChild").alias("left"),
        F.col(f"{node}.rightChild").alias("right"),
        F.when(leaf, F.lit(-1)).otherwise(F.get(places, F.col(f"{split}.featureIndex"))).alias("feature"),
        (F.col(f"{split}.numCategories") >= 0).alias("nominal"),
        F.col(f"{split}.leftCategoriesOrThreshold").alias("goes_left"),
        F.when(leaf, value).otherwise(0.0).alias("value"),
        F.col(f"{node}.rawCount").cast("double").alias("cover"),
    )


def forest(spark: SparkSession, models: Mapping[int, Model], slots: Mapping[int, Sequence[int]] | None = None) -> Forest:
    """The node tables of several models as arrays; the nodes, not the data, come to the driver."""
    nodes: list[tuple] = []
    roots: dict[int, list[int]] = {}
    for key, model in models.items():
        rows = node_table(spark, model, None if slots is None else slots[key]).orderBy("tree", "node").collect()
        start, roots[key] = len(nodes), []
        first: dict[int, int] = {}
        for k, row in enumerate(rows):
            if row.tree not in first:
                first[row.tree] = start + k
                roots[key].append(start + k)
        nodes += [(row, first[row.tree]) for row in rows]
    categories = [row.goes_left if row.nominal else [] for row, _ in nodes]
    known = np.zeros((len(nodes), 1 + int(max((c for one in categories for c in one), default=0)) + 1), dtype=bool)
    for k, one in enumerate(categories):
        known[k, np.array(one, dtype=int)] = True
    return Forest(
        np.array([base + row.left if row.feature >= 0 else -1 for row, base in nodes], dtype=np.int64),
        np.array([base + row.right if row.feature >= 0 else -1 for row, base in nodes], dtype=np.int64),
        np.array([row.feature for row, _ in nodes], dtype=np.int64),
        np.array([row.goes_left[0] if row.feature >= 0 and not row.nominal else 0.0 for row, _ in nodes]),
        np.array([row.feature >= 0 and row.nominal for row, _ in nodes], dtype=bool),
        known,
        np.array([row.value for row, _ in nodes], dtype=float),
        np.array([row.cover for row, _ in nodes], dtype=float),
        roots,
        {key: isinstance(model, GBTClassificationModel) for key, model in models.items()},
        1 + max((row.feature for row, _ in nodes), default=0),
    )


def turns_left(trees: Forest, node: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether inputs ``value`` of inner nodes ``node`` lead to the left child; a missing number leads to the right."""
    last = trees.goes_left.shape[1] - 1  # a category that no split names
    code = np.where(np.isfinite(value) & (value >= 0) & (value < last), value, last).astype(np.int64)
    return np.where(trees.nominal[node], trees.goes_left[node, code], value <= trees.threshold[node])


def margins(trees: Forest, key: int, x: np.ndarray) -> np.ndarray:
    """Sum of the leaves that each row of ``x`` reaches in the trees of one model."""
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for root in trees.roots[key]:
        node = np.full(len(x), root)
        while True:
            inner = trees.feature[node] >= 0
            if not inner.any():
                break
            down = turns_left(trees, node[inner], x[rows[inner], trees.feature[node[inner]]])
            node[inner] = np.where(down, trees.left[node[inner]], trees.right[node[inner]])
        total += trees.value[node]
    return total


def probabilities(trees: Forest, key: int, x: np.ndarray) -> np.ndarray:
    margin = margins(trees, key, x)
    return 1.0 / (1.0 + np.exp(-2.0 * margin)) if trees.boosted[key] else margin


def matrix(features: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as a matrix of at least ``width`` columns."""
    flat = features.flatten().to_numpy(zero_copy_only=False)
    found = flat.reshape(len(features), -1) if len(features) else np.zeros((0, width))
    return found if found.shape[1] >= width else np.pad(found, ((0, 0), (0, width - found.shape[1])))


def score_by_key(df: DataFrame, trees: Forest, key: str, features: str, name: str = "p") -> DataFrame:
    """``df`` with the score of each row by the model that ``key`` names; null without such a model. ``features`` is an array column."""
    held = df.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("double")
    def scored(chosen: pa.Array, values: pa.Array) -> pa.Array:
        x, keys = matrix(values, held.value.width), chosen.to_pylist()
        out, known = np.zeros(len(x)), np.zeros(len(x), dtype=bool)
        for one in set(keys) & held.value.roots.keys():
            mine = np.array([k == one for k in keys])
            out[mine], known[mine] = probabilities(held.value, one, x[mine]), True
        return pa.array(out, mask=~known)

    return df.withColumn(name, scored(F.col(key).cast("bigint"), F.col(features)))


class Path(NamedTuple):
    """The way to a leaf: its inner nodes, the turn at each, the place of their feature in ``features``, and each feature's share of cover."""

    nodes: list[int]
    turns: list[bool]
    owner: list[int]
    features: list[int]
    share: np.ndarray
    value: float


def paths(trees: Forest, key: int) -> list[Path]:
    found = []

    def walk(node: int, way: list[tuple[int, bool]]) -> None:
        if trees.feature[node] >= 0:
            walk(int(trees.left[node]), [*way, (node, True)])
            walk(int(trees.right[node]), [*way, (node, False)])
            return
        features = list(dict.fromkeys(int(trees.feature[n]) for n, _ in way))
        share = np.ones(len(features))
        owner = [features.index(int(trees.feature[n])) for n, _ in way]
        for (n, turn), place in zip(way, owner, strict=True):
            child = trees.left[n] if turn else trees.right[n]
            share[place] *= trees.cover[child] / trees.cover[n]
        found.append(Path([n for n, _ in way], [t for _, t in way], owner, features, share, float(trees.value[node])))

    for root in trees.roots[key]:
        walk(root, [])
    return found


def leaf_shares(path: Path, met: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf's game for rows of ``met`` (which of the leaf's features lead to it).

    Without a feature a row goes to the leaf by the feature's share of cover. The products over
    the other features are a polynomial whose k-th coefficient sums all coalitions of k features.
    """
    size = len(path.features)
    weight = np.array([factorial(k) * factorial(size - k - 1) / factorial(size) for k in range(size)])
    out = np.zeros(met.shape)
    for i in range(size):
        terms = np.zeros((len(met), size))
        terms[:, 0] = 1.0
        for j in range(size):
            if j != i:
                grown = terms * path.share[j]
                grown[:, 1:] += terms[:, :-1] * met[:, j : j + 1]
                terms = grown
        out[:, i] = path.value * (met[:, i] - path.share[i]) * (terms @ weight)
    return out


def attributions(trees: Forest, key: int, x: np.ndarray, ways: Sequence[Path]) -> np.ndarray:
    """What each input adds to the margin of each row, beside ``expected_margin``."""
    out = np.zeros((len(x), x.shape[1]))
    turn = {n: turns_left(trees, np.full(len(x), n), x[:, trees.feature[n]]) for n in {n for way in ways for n in way.nodes}}
    for way in ways:
        if not way.features:
            continue
        met = np.ones((len(x), len(way.features)), dtype=bool)
        for node, left, place in zip(way.nodes, way.turns, way.owner, strict=True):
            met[:, place] &= turn[node] == left
        pattern, back = np.unique(met, axis=0, return_inverse=True)
        out[:, way.features] += leaf_shares(way, pattern.astype(float))[back.ravel()]
    return out


def expected_margin(ways: Sequence[Path]) -> float:
    """The margin without any input: every leaf by its share of cover."""
    return float(sum(way.value * way.share.prod() for way in ways))


def attribution(trees: Forest, key: int, features: Column) -> Column:
    """Array of attributions of an array column; with ``expected_margin`` they add up to the row's margin."""
    ways = paths(trees, key)

    @F.arrow_udf("array<double>")
    def attributed(values: pa.Array) -> pa.Array:
        x = matrix(values, trees.width)
        found = attributions(trees, key, x, ways)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))

    return attributed(features)
