"""Aggregate expression builders shared by profiling, imputation, scaling and rollout metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """ANSI-safe ratio: NULL instead of an error on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """Zero-division-is-zero ratio (metric convention)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")
