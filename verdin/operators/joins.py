"""Lookups, latest-record joins, membership tests and index matches.

No join here forces a broadcast of a table that grows. Spark compares the size
of a side with its broadcast threshold and otherwise sorts and merges, splitting
hot keys at run time. Right sides are reduced to one row per key first,
except in ``fill_from``, where every row of the table counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.operators.ranking import first_per_key


def latest_per_key(df: DataFrame, key: str, moment: str, before: Column | None = None) -> DataFrame:
    """All rows at the latest moment of their key (ties kept), among rows before a cutoff.

    The maximum per key is combined on the map side, then joined back, so the
    rows of a hot key never meet in one sort. ``before`` limits the moments that
    are considered.
    """
    eligible = df if before is None else df.where(F.col(moment) < before)
    latest = eligible.groupBy(F.col(key).alias("_key")).agg(F.max(moment).alias("_latest"))
    joined = df.join(latest, (F.col(key) == F.col("_key")) & (F.col(moment) == F.col("_latest")))
    return joined.select(*df.columns)


def chain_left(base: DataFrame, steps: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Left joins one after another; each step maps base columns to the columns of its table.

    Key columns of the joined tables are dropped, repeated matches multiply rows
    as in SQL, and a name that already exists is refused.
    """
    result = base
    for table, keys in steps:
        values = [c for c in table.columns if c not in keys.values()]
        clash = [c for c in values if c in result.columns]
        if clash:
            raise ValueError(f"columns exist already: {clash}")
        side = table.select(*[F.col(right).alias(f"_join_{right}") for right in keys.values()], *values)
        match = [F.col(left) == F.col(f"_join_{right}") for left, right in keys.items()]
        result = result.join(side, match, "left").drop(*[f"_join_{right}" for right in keys.values()])
    return result


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    value: str,
    last: str,
    name: str | None = None,
    default: object = "",
) -> DataFrame:
    """Add one value by key; among repeated keys the row with the largest ``last`` wins."""
    unique = table.groupBy(F.col(table_key).alias("_key")).agg(F.max_by(value, last).alias("_value"))
    joined = df.join(unique, F.col(key) == F.col("_key"), "left")
    return joined.select(*df.columns, F.coalesce(F.col("_value"), F.lit(default)).alias(name or value))


def fill_from(
    df: DataFrame, table: DataFrame, key: str, prefer: Sequence[str] = (), fill_empty: Sequence[str] = ()
) -> DataFrame:
    """Left join on a trimmed lower-case key, then fill.

    A key that the table has several times gives as many rows.
    Columns in ``prefer`` take the table's value when it has one; columns in
    ``fill_empty`` take it only where the own value is the empty text.
    """
    names = [*prefer, *fill_empty]
    tidy = F.lower(F.trim(F.col(key).cast("string")))
    side = table.select(tidy.alias("_key"), *[F.col(n).alias(f"_meta_{n}") for n in names])
    joined = df.withColumn(key, tidy).join(side, F.col(key) == F.col("_key"), "left")
    filled = {n: F.coalesce(F.col(f"_meta_{n}"), F.col(n)) for n in prefer}
    filled |= {n: F.when(F.col(n) == "", F.col(f"_meta_{n}")).otherwise(F.col(n)) for n in fill_empty}
    return joined.withColumns(filled).select(*df.columns)


def first_match(
    df: DataFrame, table: DataFrame, key: Column, table_key: Column, order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """Left join on computed keys; rows without a key stay unmatched, the table keeps its first row per key."""
    keyed = table.withColumn("_key", table_key).where(F.col("_key").isNotNull())
    unique = first_per_key(keyed, ["_key"], order).select("_key", *values)
    return df.withColumn("_own", key).join(unique, F.col("_own") == F.col("_key"), "left").drop("_own", "_key")


def found(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in the key set."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def not_found(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the key set."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def exists_flag(df: DataFrame, keys: DataFrame, key: str, other: str, name: str) -> DataFrame:
    """1 when the key occurs in the other table, else 0."""
    present = keys.select(F.col(other).alias("_key")).distinct()
    joined = df.join(present, F.col(key) == F.col("_key"), "left")
    return joined.select(*df.columns, F.col("_key").isNotNull().cast("int").alias(name))


def any_key_found(df: DataFrame, keys: Column, index: DataFrame, index_key: str, row_id: str, name: str) -> DataFrame:
    """1 when any of the row's candidate keys is in the index."""
    candidates = df.select(F.col(row_id).alias("_id"), F.explode(keys).alias("_key"))
    seen = index.select(F.col(index_key).alias("_key")).distinct()
    hits = candidates.join(seen, "_key", "left_semi").select("_id").distinct()
    joined = df.join(hits, F.col(row_id) == F.col("_id"), "left")
    return joined.select(*df.columns, F.col("_id").isNotNull().cast("int").alias(name))


def role_of(
    df: DataFrame,
    folder: str,
    roles: DataFrame,
    special: Sequence[str],
    special_role: str,
    domain: str,
    missing_role: str,
) -> DataFrame:
    """Mail and role of a folder owner: fixed ones for special folders, else by lookup, else a default label.

    ``roles`` has the columns mail, role and line; the largest line wins.
    """
    owner = F.lower(F.trim(folder))
    is_special = owner.isin(*special)
    named = df.withColumn("mail", F.when(is_special, F.concat(owner, F.lit(domain))).otherwise(owner))
    table = roles.select(F.lower("mail").alias("_mail"), "role", "line")
    joined = lookup(named, table, "mail", "_mail", "role", "line", "_role", None)
    role = F.when(is_special, F.lit(special_role)).otherwise(F.coalesce("_role", F.lit(missing_role)))
    return joined.withColumn("role", role).drop("_role")
