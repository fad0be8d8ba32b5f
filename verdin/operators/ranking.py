"""Worklists of the best M, data splits, time folds and first-or-last rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdin.operators import ordered


def flag_top(df: DataFrame, m: int, p: str = "p", flag: str = "selected") -> DataFrame:
    """Flag the rows at or above the ``m``-th largest score; everything tied with it is flagged too."""
    threshold = F.lit(ordered.nth_largest(df, p, m)).cast("double")
    return df.withColumns({flag: (F.col(p) >= threshold).cast("int"), "threshold": threshold})


def flag_top_pending(df: DataFrame, m: int, done: Column, p: str = "p", flag: str = "selected") -> DataFrame:
    """:func:`flag_top` among the rows that are not done; only those are returned."""
    return flag_top(df.where(~done), m, p, flag)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order; 0 keeps all rows."""
    ranked = df.orderBy(*order)
    return ranked.limit(n) if n > 0 else ranked


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first of the order.

    Spark keeps one row per key on the map side of this window, so a hot key
    sends at most one row per task.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group with their ``place``; also limited on the map side."""
    place = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def split_last_period(df: DataFrame, period_order: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the last period, and rows of the last period."""
    last = df.agg(F.max(period_order)).first()[0]
    return df.where(F.col(period_order) < F.lit(last)), df.where(F.col(period_order) == F.lit(last))


def time_folds(df: DataFrame, order: Sequence[Column], folds: int = 5) -> DataFrame:
    """Expanding time folds: ``fold`` k (1..folds) is scored by a model fitted on all rows before it.

    Each fold has rows // (folds + 1) rows counted from the end; rows before the
    first fold get 0.
    """
    placed = ordered.row_number(df, order, "_place")
    rows = df.count()
    size = rows // (folds + 1)
    first = rows - folds * size
    if size == 0:
        raise ValueError(f"{rows} rows are too few for {folds} folds")
    fold = F.floor((F.col("_place") - 1 - first) / size) + 1
    return placed.withColumn("fold", F.greatest(fold, F.lit(0)).cast("int")).drop("_place")


def stratified_split(
    df: DataFrame, label: str, key: str, shares: dict[str, float], seed: int = 42, name: str = "part"
) -> DataFrame:
    """Assign each row to a named part so that every class is split by the same shares.

    Rows of a class are ordered by a hash of seed and key; the first share goes
    to the first part, and so on; the last part takes the rest.
    """
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    placed = ordered.row_number(df.withColumn("_mixed", mixed), [F.asc("_mixed"), F.asc(key)], "_place", [label])
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_size"))
    sized = placed.join(sizes, F.col(label).eqNullSafe(F.col("_class")))
    parts, upto = list(shares), 0.0
    choice = F.lit(None).cast("string")
    for part in parts[:-1]:
        upto += shares[part]
        choice = F.coalesce(choice, F.when(F.col("_place") <= F.round(F.col("_size") * F.lit(upto)), F.lit(part)))
    return sized.withColumn(name, F.coalesce(choice, F.lit(parts[-1]))).drop("_mixed", "_place", "_class", "_size")


def last_value_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The value of the latest row per key; combined on the map side."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))
