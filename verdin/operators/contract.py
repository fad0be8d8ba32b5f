"""Schema contracts: match columns to a catalog, convert types, and report what could not be converted."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: type families of the catalog, and the words read as a bit
INTEGERS = ("int", "bigint", "smallint", "tinyint")
NUMBERS = ("decimal", "numeric", "float", "real", "money", "smallmoney")
MOMENTS = ("date", "datetime", "datetime2", "smalldatetime", "datetimeoffset", "time")
TRUE_WORDS = ("1", "true", "t", "si", "sí", "s", "y", "yes")
FALSE_WORDS = ("0", "false", "f", "no", "n")


@dataclass(frozen=True)
class Field:
    """One catalog column."""

    name: str
    kind: str
    nullable: bool = True
    max_length: int | None = None


def match_columns(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Catalog columns in catalog order, matched by trimmed lower-case name; extras are dropped."""
    have = {c.strip().lower(): c for c in df.columns}
    missing = sorted(f.name for f in fields if f.name.lower() not in have)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select([F.col(f"`{have[f.name.lower()]}`").alias(f.name) for f in fields])


def to_bit(value: Column) -> Column:
    """1 or 0 for a yes or no word, null for anything else."""
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0)


def convert(value: Column, field: Field) -> Column:
    """Value in the type the catalog asks for; null when it cannot be converted.

    Integers pass through double, so ``1e3`` is 1000; a fraction is not an integer.
    """
    kind = field.kind.lower()
    if kind in INTEGERS:
        number = F.trim(value.cast("string")).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    if kind in NUMBERS:
        return F.trim(value.cast("string")).try_cast("double")
    if kind in MOMENTS:
        return value.cast("string").try_cast("timestamp_ntz")
    if kind == "bit":
        return to_bit(value)
    text = value.cast("string")
    return F.left(text, F.lit(field.max_length)) if field.max_length and field.max_length > 0 else text


def convert_all(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    matched = match_columns(df, fields)
    return matched.select([convert(F.col(f.name), f).alias(f.name) for f in fields])


def conversion_report(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Per required column, how many filled values could not be converted; all columns in one pass."""
    matched = match_columns(df, fields)
    checked = [f for f in fields if not f.nullable]

    def lost(field: Field) -> Column:
        filled = F.col(field.name).isNotNull() & (F.trim(F.col(field.name).cast("string")) != "")
        return F.count_if(filled & convert(F.col(field.name), field).isNull()).alias(field.name)

    counts = matched.agg(*[lost(f) for f in checked])
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(f.name).alias("column"), F.lit(f.kind).alias("type"), F.col(f.name).alias("lost"))
                for f in checked
            ]
        )
    ).alias("pair")
    return counts.select(pairs).select("pair.*")


def convert_strictly(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """:func:`convert_all`, refused with all findings when a required value would be lost."""
    # one row per catalog column
    findings = [r for r in conversion_report(df, fields).collect() if r["lost"]]
    if findings:
        raise ValueError("; ".join(f"{r['column']} ({r['type']}): {r['lost']} values not convertible" for r in findings))
    return convert_all(df, fields)
