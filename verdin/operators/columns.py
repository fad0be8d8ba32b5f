"""Projections built while planning: names, defaults, recodes and fills."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdin.functions.numbers import null_to_zero_sum


def require(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail with the list of missing columns, else return ``df``."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def plain(text: str) -> str:
    """Lower case without accents, for comparing column names."""
    split = unicodedata.normalize("NFD", text)
    return "".join(c for c in split if unicodedata.category(c) != "Mn").strip().lower()


def pick_column(df: DataFrame, preferred: Sequence[str], contains: str | None = None) -> str:
    """First preferred name that exists, else the first whose accent-free name contains a text."""
    for name in preferred:
        if name in df.columns:
            return name
    if contains is not None:
        for name in df.columns:
            if contains in plain(name):
                return name
    raise KeyError(f"none of {list(preferred)} found")


def tidy_header(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def safe_name(name: str) -> str:
    """Blanks to underscores, everything but letters, digits and underscores removed."""
    return re.sub(r"[^A-Za-z0-9_]+", "", name.replace(" ", "_"))


def rename_safely(df: DataFrame) -> DataFrame:
    """:func:`safe_name` on all columns; fails when two names would become one."""
    names = [safe_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"names clash after tidying: {clashes}")
    return df.toDF(*names)


def drop_repeated(df: DataFrame, keep: str = "first") -> DataFrame:
    """Keep the first or the last of columns with equal names."""
    names = df.columns
    order = range(len(names)) if keep == "first" else range(len(names) - 1, -1, -1)
    chosen: dict[str, int] = {}
    for position in order:
        chosen.setdefault(names[position], position)
    numbered = df.toDF(*[f"_{i}" for i in range(len(names))])
    return numbered.select([F.col(f"_{i}").alias(names[i]) for i in sorted(chosen.values())])


def fixed_schema(df: DataFrame, schema: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the named columns in the given order; absent ones become a default or null."""
    defaults = defaults or {}

    def column(name: str, kind: str) -> Column:
        if name in df.columns:
            return F.col(name).cast(kind).alias(name)
        return F.lit(defaults.get(name)).cast(kind).alias(name)

    return df.select([column(name, kind) for name, kind in schema.items()])


def numbered_columns(df: DataFrame, stem: str, count: int) -> DataFrame:
    """Columns ``stem#1..count``; when none exists, a single column ``stem`` becomes number 1."""
    names = [f"{stem}#{i}" for i in range(1, count + 1)]
    found = [n for n in names if n in df.columns]
    source = {n: F.col(f"`{n}`") for n in found}
    if not found and stem in df.columns:
        source[names[0]] = F.col(stem)
    others = [F.col(f"`{c}`") for c in df.columns if c not in found]
    return df.select(*others, *[source.get(n, F.lit(None).cast("string")).alias(n) for n in names])


def recode(value: Column, mapping: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """Replace listed values; the rest (nulls too) becomes ``otherwise``, or stays as it is."""
    choice = None
    for old, new in mapping.items():
        choice = F.when(value == old, F.lit(new)) if choice is None else choice.when(value == old, F.lit(new))
    rest = value if otherwise is None else otherwise
    return rest if choice is None else choice.otherwise(rest)


def zero_nulls(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(names))


def interaction_columns(df: DataFrame, patterns: Sequence[str]) -> list[str]:
    """Numeric columns whose lower-case name contains one of the patterns."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and any(p in f.name.lower() for p in patterns)
    ]


def interaction_total(df: DataFrame, patterns: Sequence[str]) -> Column | None:
    found = interaction_columns(df, patterns)
    return null_to_zero_sum([F.col(c) for c in found]) if found else None


def feature_kinds(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical names among the features that exist."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    present = [f for f in features if f in fields]
    numeric = [f for f in present if isinstance(fields[f], (T.NumericType, T.BooleanType))]
    return numeric, [f for f in present if f not in numeric]
