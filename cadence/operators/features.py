"""Feature creation: interactions (F11), squares (F12), date parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.columns import datetime_columns


def create_features(df: DataFrame, interactions: list[tuple[str, str]] | None = None,
                    polynomial: list[str] | None = None, date_parts: bool = True) -> DataFrame:
    """Append ``a_x_b``, ``a_squared`` for listed columns that exist, then, for every
    timestamp/date column, ``_year, _month, _day, _dayofweek`` (Monday = 0)."""
    new = {}
    for a, b in interactions or []:
        if a in df.columns and b in df.columns:
            new[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    for a in polynomial or []:
        if a in df.columns:
            new[f"{a}_squared"] = F.pow(F.col(a), 2)
    if date_parts:
        for c in datetime_columns(df):
            new[f"{c}_year"] = F.year(c)
            new[f"{c}_month"] = F.month(c)
            new[f"{c}_day"] = F.dayofmonth(c)
            new[f"{c}_dayofweek"] = F.weekday(c)
    return df.withColumns(new) if new else df
