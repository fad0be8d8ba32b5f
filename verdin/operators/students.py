"""The student base: latest enrolment with its satellites, and the cleaning rules of its columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.functions.dates import age_in_years, days_since
from verdin.functions.text import normalise_key
from verdin.operators import joins
from verdin.operators.columns import recode, require, zero_nulls

# fixed values: the texts of the cleaned columns
WORKS, WORKS_NOT = "TRABAJA", "NO TRABAJA"
YES, NO, ACTIVE, PAID = "SI", "NO", "ACTIVO", "PAGO"
MODALITIES = {"Presencial Fin De Semana": "Presencial", "No Presencial": "Virtual"}
STATES = {"Nuevo - Homologado": "NUEVO"}


def student_base(
    enrolments: DataFrame,
    key: str,
    moment: str,
    cutoff: Column,
    approvals: DataFrame,
    approval_keys: Sequence[str],
    satellites: Sequence[tuple[DataFrame, Mapping[str, str]]],
) -> DataFrame:
    """Latest enrolment per student before a cutoff, with approvals (required) and satellites (optional).

    Satellites that match several times multiply the row; tables that give no
    column do not belong in the list.
    """
    latest = joins.latest_per_key(enrolments, key, moment, cutoff)
    return joins.chain_left(latest.join(approvals, list(approval_keys)), satellites)


def canonical(name: Column, names: Mapping[str, str]) -> Column:
    """Standardised name, replaced once when it is in the mapping."""
    return recode(normalise_key(name), names)


def clean_students(
    df: DataFrame,
    as_of: dt.date,
    dropout: str,
    names: Mapping[str, Mapping[str, str]],
    measures: Sequence[str],
    modalities: Mapping[str, str] = MODALITIES,
    states: Mapping[str, str] = STATES,
) -> DataFrame:
    """Apply the cleaning rules.

    Expects birth_date, company, status, student_state, modality, payment_state,
    last_access, grade, lms_state, schedule and mail. ``names`` maps name columns
    to their replacements, ``measures`` get 0 for null.
    """
    require(
        df,
        ["birth_date", "company", "status", "student_state", "modality", "payment_state", "last_access", "grade", "lms_state", "schedule", "mail"],
    )
    today = F.lit(as_of)
    graded = F.col("grade").isNotNull()
    cleaned = df.withColumns(
        {
            "age": age_in_years(F.col("birth_date"), today),
            "works": F.when(F.trim("company") != "", F.lit(WORKS)).otherwise(F.lit(WORKS_NOT)),
            "status": F.when(F.col("status") == dropout, 1).otherwise(0),
            "student_state": recode(F.col("student_state"), states),
            "modality": recode(F.col("modality"), modalities),
            "payment_state": recode(F.col("payment_state"), {PAID: PAID}, F.lit(NO)),
            "days_since_access": days_since(F.col("last_access").try_cast("date"), today),
            "lms_state": F.when(graded, F.lit(ACTIVE)).otherwise(F.col("lms_state")),
            "schedule": F.when(graded, F.lit(YES)).otherwise(F.lit(NO)),
            "mail": recode(F.col("mail"), {YES: YES}, F.lit(NO)),
            **{column: canonical(F.col(column), mapping) for column, mapping in names.items()},
        }
    )
    return zero_nulls(cleaned, measures)
