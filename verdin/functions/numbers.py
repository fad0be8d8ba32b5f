"""Numeric helpers on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def logit(p: Column, eps: float = 1e-6) -> Column:
    """Log-odds of a probability kept away from 0 and 1 by ``eps``."""
    safe = clip(p, eps, 1 - eps)
    return F.log(safe / (1 - safe))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def add(terms: list[Column]) -> Column:
    """Sum in the given order, so that float results do not depend on the planner."""
    return reduce(lambda a, b: a + b, terms)


def null_to_zero_sum(columns: list[Column]) -> Column:
    """Row sum that counts nulls as zero."""
    return add([F.coalesce(c, F.lit(0)) for c in columns])


def ratio(part: Column, whole: Column) -> Column:
    """Quotient that is 0 when the denominator is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.when(whole != 0, whole))
