"""Ordered period codes, payment state and the re-enrolment label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the period codes in their order in time
PERIODS = (
    "23V04", "2023B", "23V05", "23V06",
    "24V01", "2024A", "24V02", "24V03", "24P02", "24V04", "2024B", "24V05", "24V06",
    "25V02", "2025B", "25V05", "2025D",
)
NOT_PAID = "NO HA PAGADO"
PAID = "YA PAGO"


def tidy_period(code: Column) -> Column:
    return F.upper(F.trim(code.cast("string")))


def period_order(code: Column, periods: Sequence[str] = PERIODS) -> Column:
    """1-based position of a code in the period list, null when unknown."""
    place = F.array_position(F.array(*[F.lit(p.upper()) for p in periods]), code)
    return F.when(place > 0, place.cast("int"))


def with_period_order(df: DataFrame, period: str, name: str = "period_order", periods: Sequence[str] = PERIODS):
    """Tidied period, its order, and only the rows with a known period."""
    tidy = df.withColumn(period, tidy_period(F.col(period)))
    return tidy.withColumn(name, period_order(F.col(period), periods)).where(F.col(name).isNotNull())


def paid_later(state: Column, own: Column, paid: Column, periods: Sequence[str] = PERIODS) -> Column:
    """1 when the state is "paid" and the paid period comes after the own period, else 0."""
    later = period_order(paid, periods) > period_order(own, periods)
    return F.when((F.upper(state) == PAID) & later, 1).otherwise(0)


def payment_state(own: Column, paid: Column) -> dict[str, Column]:
    """State and paid period from the last paid period (null when there is none)."""
    unpaid = paid.isNull() | (paid == own)
    return {
        "payment_state": F.when(unpaid, F.lit(NOT_PAID)).otherwise(F.lit(PAID)),
        "paid_period": F.coalesce(paid, F.lit(NOT_PAID)),
    }


def last_paid_period(
    receipts: DataFrame, key: str, period: str, by: str = "text", periods: Sequence[str] = PERIODS
) -> DataFrame:
    """Last paid period per key: largest as text, or latest in the period order."""
    if by == "text":
        last = F.max(period)
    elif by == "ordinal":
        last = F.max_by(period, period_order(F.col(period), periods))
    else:
        raise ValueError("by is 'text' or 'ordinal'")
    return receipts.groupBy(key).agg(last.alias("last_paid"))


def enrolment_base(
    enrolments: DataFrame,
    receipts: DataFrame,
    key: str,
    period: str,
    paid_periods: Sequence[str],
    place_periods: Sequence[str],
    places: Sequence[str],
    novelty: str,
    by: str = "text",
    periods: Sequence[str] = PERIODS,
) -> DataFrame:
    """Enrolments with payment state and with novelty and place of their own period.

    ``receipts`` holds paid, not annulled receipts with the same key and period
    names. Several places in one period multiply the row, as in SQL.
    """
    last = last_paid_period(receipts.where(F.col(period).isin(*paid_periods)), key, period, by, periods)
    own = (
        receipts.where(F.col(period).isin(*place_periods))
        .groupBy(key, period, *places)
        .agg(F.max(novelty).alias(novelty))
    )
    joined = enrolments.join(last, key, "left").join(own, [key, period], "left")
    return joined.withColumns(payment_state(F.col(period), F.col("last_paid"))).drop("last_paid")


def recode_status(status: Column, state: Column) -> Column:
    """Status of students who paid although listed as leaving or finished."""
    # fixed values: the status texts
    return (
        F.when((status == "Retiro") & (state == PAID), F.lit("Posible Perdida Academica"))
        .when((status == "Posible Egresado") & (state == PAID), F.lit("Posible Rematricula"))
        .otherwise(status)
    )
