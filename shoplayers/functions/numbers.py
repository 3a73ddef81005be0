"""Guarded and rounded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 for an empty denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded once, half away from zero; NULL when `whole` is 0."""
    exact = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(exact, digits).cast("double")


def money_mean(amount: str) -> Column:
    """Mean of a money column in cents, rounded once."""
    return F.round(F.sum(amount) / F.count(amount), 2).cast("decimal(14,2)")


def f_score(precision: Column, recall: Column) -> Column:
    return ratio(F.lit(2.0) * precision * recall, precision + recall)
