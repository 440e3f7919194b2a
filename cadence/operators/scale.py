"""Scaling: standard (F08, F09; population std, zero variance -> divisor 1) and min-max.

Fit = one aggregate pass giving two literals per column; apply = one projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.columns import nan_to_null, numeric_columns


@dataclass
class ScaleParams:
    method: str
    # column -> (centre, divisor); centre None = all-null column (stays NULL)
    params: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)


def fit_scaler(df: DataFrame, columns: list[str] | None = None, method: str = "standard",
               exclude: list[str] | None = None) -> ScaleParams:
    if method not in ("standard", "minmax"):
        raise ValueError(f"Unknown scaling method: {method}")
    cols = [c for c in (columns if columns is not None else numeric_columns(df))
            if c not in (exclude or [])]
    out = ScaleParams(method)
    if not cols:
        return out
    base = nan_to_null(df.select(*cols))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if method == "standard":
            aggs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"b{i}")]
        else:
            aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
    row = base.agg(*aggs).first()  # one row, two numbers per column
    for i, c in enumerate(cols):
        a, b = row[f"a{i}"], row[f"b{i}"]
        if a is None:
            out.params[c] = (None, None)
        elif method == "standard":
            out.params[c] = (a, b if b else 1.0)
        else:
            rng = b - a
            out.params[c] = (a, rng if rng else 0.0)
    return out


def scaler_from_moments(moments: dict, method: str = "standard") -> ScaleParams:
    """Scaler from {column: moments}, objects with n, mean, m2 (sum of squared deviations), low and high."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"Unknown scaling method: {method}")
    out = ScaleParams(method)
    for c, m in moments.items():
        if not m.n:
            out.params[c] = (None, None)
        elif method == "standard":
            out.params[c] = (m.mean, math.sqrt(m.m2 / m.n) or 1.0)
        else:
            out.params[c] = (m.low, m.high - m.low)
    return out


def apply_scaler(df: DataFrame, sp: ScaleParams) -> DataFrame:
    df = nan_to_null(df, list(sp.params))
    out = {}
    for c, (centre, div) in sp.params.items():
        x = F.col(c).cast("double")
        if centre is None:
            out[c] = x
        elif sp.method == "minmax" and div == 0.0:
            out[c] = F.when(x.isNotNull(), F.lit(0.0))
        else:
            out[c] = (x - F.lit(centre)) / F.lit(div)
    return df.withColumns(out)


def standard_scale(df: DataFrame, columns: list[str] | None = None,
                   exclude: list[str] | None = None) -> DataFrame:
    """(x - mean) / std_pop, divisor 1 for zero variance; NULLs ignored and kept."""
    return apply_scaler(df, fit_scaler(df, columns, "standard", exclude))


def minmax_scale(df: DataFrame, columns: list[str] | None = None,
                 exclude: list[str] | None = None) -> DataFrame:
    """(x - min) / (max - min), 0 when the range is 0."""
    return apply_scaler(df, fit_scaler(df, columns, "minmax", exclude))


def scaler_table(sp: ScaleParams, spark) -> DataFrame:
    rows = [(c, a, b) for c, (a, b) in sp.params.items()]
    return spark.createDataFrame(rows, "column string, centre double, divisor double")


def load_scaler(table: DataFrame, method: str) -> ScaleParams:
    """Parameters back from a ``scaler_table`` (one row per column)."""
    return ScaleParams(method, {r["column"]: (r["centre"], r["divisor"]) for r in table.collect()})
