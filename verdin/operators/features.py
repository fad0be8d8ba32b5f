"""Feature building: counts of values, rare groups, encodings, imputations, weekly datasets, sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdin.operators import ordered
from verdin.operators.columns import rename_safely, safe_name

def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value (null is a value) and their share, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), F.asc(column))


def cardinality(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.agg(*[F.countDistinct(n).alias(n) for n in names])


def group_rare(df: DataFrame, column: str, threshold: int, other: str) -> DataFrame:
    """Values with fewer than ``threshold`` rows become ``other``; null stays null."""
    counts = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    frequent = counts.where(F.col("_rows") >= threshold).select("_value")
    joined = df.join(frequent, F.col(column) == F.col("_value"), "left")
    kept = F.when(F.col(column).isNull() | F.col("_value").isNotNull(), F.col(column)).otherwise(F.lit(other))
    return joined.select([kept.alias(c) if c == column else F.col(c) for c in df.columns])


def levels(df: DataFrame, column: str, limit: int = 2000) -> list:
    """Sorted distinct values of a column that becomes part of the plan.

    Every value becomes a column, so more than ``limit`` of them are refused.
    """
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values; group rare values first")
    return sorted(found)


def one_hot(df: DataFrame, names: Sequence[str], limit: int = 2000) -> tuple[DataFrame, dict[str, list[str]]]:
    """0/1 columns per value and one for null; also which columns each variable became.

    A variable with more than ``limit`` values is refused: group its rare values first.
    """
    made: dict[str, list[str]] = {}
    extra: list[Column] = []
    for name in names:
        made[name] = []
        for value in levels(df, name, limit):
            made[name].append(f"{name}_{value}")
            extra.append(F.coalesce((F.col(name) == F.lit(value)).cast("int"), F.lit(0)).alias(f"{name}_{value}"))
        made[name].append(f"{name}_nan")
        extra.append(F.col(name).isNull().cast("int").alias(f"{name}_nan"))
    kept = [F.col(c) for c in df.columns if c not in names]
    encoded = rename_safely(df.select(*kept, *extra))
    return encoded, {name: [safe_name(c) for c in columns] for name, columns in made.items()}


def available(first_week: Mapping[str, int], week: int) -> list[str]:
    """Variables known by a week, in name order."""
    return sorted(v for v, first in first_week.items() if first <= week)


def availability(df: DataFrame, weeks: int) -> DataFrame:
    """(variable, first_week) rows to one row per variable and week it is known in."""
    return df.select("variable", F.explode(F.sequence(F.col("first_week"), F.lit(weeks))).alias("week"))


def weekly_rows(df: DataFrame, weeks: int, name: str = "week") -> DataFrame:
    """Every row once per week 1..weeks, without a join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(weeks))))


def weekly_table(df: DataFrame, keys: Sequence[str], first_week: Mapping[str, int], week: int) -> DataFrame:
    """Keys plus the variables known by a week, categories one-hot encoded."""
    known = [v for v in available(first_week, week) if v in df.columns]
    texts = [f.name for f in df.schema.fields if f.name in known and f.dataType.typeName() == "string"]
    return one_hot(df.select(*keys, *known), texts)[0]


def weekly_tables(df: DataFrame, keys: Sequence[str], first_week: Mapping[str, int], weeks: Sequence[int]) -> dict[int, DataFrame]:
    """The weekly table of each of the weeks."""
    return {week: weekly_table(df, keys, first_week, week) for week in weeks}


def sequence_table(df: DataFrame, keys: Sequence[str], first_week: Mapping[str, int], weeks: int = 16) -> DataFrame:
    """One row per key and week; variables not known yet are null. Categories are one-hot encoded once."""
    known = [v for v in available(first_week, weeks) if v in df.columns]
    texts = [f.name for f in df.schema.fields if f.name in known and f.dataType.typeName() == "string"]
    encoded, made = one_hot(df.select(*keys, *known), texts)
    start = {c: first_week[v] for v in known for c in made.get(v, [safe_name(v)])}
    names = [safe_name(k) for k in keys]
    expanded = weekly_rows(encoded, weeks)
    values = [
        F.when(F.col("week") >= start[c], F.col(c)).alias(c) for c in encoded.columns if c not in names
    ]
    return expanded.select(*names, "week", *values)


def sequence_tensor(df: DataFrame, key: str, step: str, features: Sequence[str], order: str) -> DataFrame:
    """Per key a steps x features array over the global step list; a missing step is null.

    Repeated rows of one key and step are reduced first, the largest ``order``
    wins, so a key never gathers more than one entry per step.
    """
    values = F.array(*[F.col(f).cast("double") for f in features])
    single = df.where(F.col(step).isNotNull()).groupBy(key, step).agg(F.max_by(values, order).alias("_row"))
    steps = single.select(step).distinct().agg(F.array_sort(F.collect_list(step)).alias("_steps")).scalar()
    by_step = F.map_from_entries(F.collect_list(F.struct(step, "_row")))
    gathered = single.groupBy(key).agg(by_step.alias("_map")).withColumn("_steps", steps)
    return gathered.select(key, F.transform("_steps", lambda s: F.try_element_at(F.col("_map"), s)).alias("tensor"))


def medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column: its exact median."""
    return ordered.quantiles(_long(df, names), "value", {"median": 0.5}, ["column"])


def _long(df: DataFrame, names: Sequence[str], kind: str = "double") -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("column"), F.col(n).cast(kind).alias("value")) for n in names]
    return df.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")


def impute_medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    # one row per column
    found = {r["column"]: r["median"] for r in medians(df, names).collect()}
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(found.get(n))) for n in names})


def modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column: its most frequent value, the smallest among equals."""
    counts = _long(df, names, "string").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value")))
    return counts.withColumn("_place", best).where("_place = 1").select("column", F.col("value").alias("mode"), "n")


def impute_modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    # one row per column
    found = {r["column"]: r["mode"] for r in modes(df, names).collect()}
    kinds = dict(df.dtypes)
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(found.get(n)).cast(kinds[n])) for n in names})


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """0-based code of each distinct value in sorted order."""
    distinct = df.select(F.col(column).alias("label")).where("label IS NOT NULL").distinct()
    numbered = ordered.row_number(distinct, [F.asc("label")], "code")
    return numbered.select("label", (F.col("code") - 1).cast("int").alias("code"))


def encode_labels(df: DataFrame, column: str, codes: DataFrame, name: str, unknown: int = -1) -> DataFrame:
    """Add the code of a column's value; values without a code get ``unknown``."""
    side = codes.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
    joined = df.join(side, F.col(column) == F.col("_label"), "left")
    return joined.select(*df.columns, F.coalesce("_code", F.lit(unknown)).alias(name))


def standardise(df: DataFrame, names: Sequence[str], null_as: float | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""

    def value(n: str) -> Column:
        return F.col(n).cast("double") if null_as is None else F.coalesce(F.col(n).cast("double"), F.lit(null_as))

    # one row for all columns
    stats = df.agg(
        *[F.avg(value(n)).alias(f"{n}_mean") for n in names], *[F.stddev_pop(value(n)).alias(f"{n}_dev") for n in names]
    ).first()
    return df.withColumns(
        {n: (value(n) - F.lit(stats[f"{n}_mean"])) / F.lit(stats[f"{n}_dev"] or 1.0) for n in names}
    )


DRAWS = 1 << 20


def impute_by_frequency(df: DataFrame, column: str, key: str, seed: int = 42) -> DataFrame:
    """Fill nulls with categories drawn by their frequency.

    The draw is a number below ``DRAWS`` from a hash of key and seed, so it does
    not change when a task runs again. Categories hold the draws from their running
    total on, in the order of frequency and value; draws are assigned to
    categories by one join, however many categories there are. Without any
    category the nulls stay.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    run = ordered.running_totals(counts, [F.desc("_n"), F.asc(column)], {"_upto": F.col("_n")})
    total = counts.agg(F.sum("_n").alias("n")).scalar()
    last = F.floor(F.col("_upto") * DRAWS / total).cast("bigint") - 1
    first = F.floor((F.col("_upto") - F.col("_n")) * DRAWS / total).cast("bigint")
    spans = run.select(F.col(column).alias("_value"), first.alias("_first"), last.alias("_last")).where("_last >= _first")
    draws = spans.select("_value", F.explode(F.sequence("_first", "_last")).alias("_draw"))
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    spot = F.when(F.col(column).isNull(), F.conv(F.substring(mixed, 1, 8), 16, 10).cast("bigint") % DRAWS)
    joined = df.withColumn("_draw", spot).join(draws, "_draw", "left")
    return joined.select([F.coalesce(column, "_value").alias(column) if c == column else F.col(c) for c in df.columns])
