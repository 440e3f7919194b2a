"""Missing values: zero-as-missing (P07), drop (P08), constant fill (P09), mean / median /
mode imputation (F01-F04).

Fit is one aggregate pass (plus one grouped pass for modes) that returns a handful of
literals per column; apply is a single projection of ``coalesce(col, literal)``, so it stays
inside whole-stage codegen and never joins or shuffles the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.columns import (categorical_columns, is_missing, nan_to_null,
                                       numeric_columns)

STRATEGIES = ("mean", "median", "mode", "fill", "drop")
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Imputation:
    """Fitted fill values. ``fills[c] is None`` means the column stays NULL (all-null numeric)."""
    strategy: str
    fills: dict[str, Any] = field(default_factory=dict)
    widen: list[str] = field(default_factory=list)


def zero_as_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """0 becomes NULL on the listed columns that exist."""
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL or NaN."""
    cond = None
    for c in df.columns:
        m = is_missing(df, c)
        cond = m if cond is None else (cond | m)
    return df if cond is None else df.filter(~cond)


def fill_missing(df: DataFrame, value: Any) -> DataFrame:
    """One constant into every column that can hold it (NaN counts as missing)."""
    if value is None:
        raise ValueError("fill strategy needs a fill_value")
    out = {}
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.StringType):
            lit = F.lit(str(value))
        elif isinstance(value, (int, float)) and not isinstance(value, bool) and isinstance(
                t, (T.NumericType,)):
            if isinstance(t, INTEGRAL) and isinstance(value, float) and not value.is_integer():
                lit = F.lit(value)  # column widens to double, like a pandas int column would
            else:
                lit = F.lit(value).cast(t)
        elif isinstance(value, bool) and isinstance(t, T.BooleanType):
            lit = F.lit(value)
        else:
            continue
        base = F.nanvl(F.col(f.name), F.lit(None).cast(t)) if isinstance(t, (T.FloatType, T.DoubleType)) else F.col(f.name)
        out[f.name] = F.coalesce(base, lit)
    return df.withColumns(out)


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, Any]:
    """Most frequent non-null value per column, smallest value on ties; absent when all NULL.

    Distributed: unpivot to (column, value) -> groupBy(column, value).count() (map-side
    combined, the shuffle carries distinct values only) -> one ``min_by`` per column with a
    fixed-size buffer. A hot value costs nothing extra: it is one group after the combine.
    """
    if not columns:
        return {}
    out: dict[str, Any] = {}
    families: dict[T.DataType, list[str]] = {}
    for c in columns:
        families.setdefault(df.schema[c].dataType, []).append(c)
    for family in families.values():  # one unpivot per type: values keep it, no detour through double
        long = nan_to_null(df.select(*family)).select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in family
        ])).alias("kv")).select("kv.column", "kv.value").where(F.col("value").isNotNull())
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(
            F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
        out.update({r["column"]: r["mode"] for r in best.collect()})  # one row per column
    return out


def fit_missing(df: DataFrame, strategy: str = "mean", fill_value: Any = None,
                columns: list[str] | None = None, exact: bool = True,
                only_missing: bool = True, missing: dict[str, int] | None = None,
                zeros: dict[str, int] | None = None) -> Imputation:
    """Fit fill values. ``missing`` gives counts that are known already and spares a pass (not
    for means); ``zeros`` is filled with the number of zeros of the columns it names, on the way. Pass 1 counts missing values of every column (and takes the mean,
    when asked) in one aggregate; medians and modes are then computed only for columns that
    hold missing values (``only_missing``) - a fill value of a complete column is never
    used, and exact medians / modes are the expensive aggregates."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    params = Imputation(strategy)
    if strategy in ("fill", "drop"):
        if strategy == "fill":
            params.fills = {"*": fill_value}
        return params
    cols = columns or df.columns
    base = nan_to_null(df)
    num = [c for c in numeric_columns(df) if c in cols]
    cat = [c for c in categorical_columns(df) if c in cols]
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    aggs += [F.count_if(F.col(c) == 0).alias(f"z{i}") for i, c in enumerate(zeros or {})]
    if strategy == "mean":
        aggs += [F.avg(c).cast("double").alias(f"a{i}") for i, c in enumerate(cols) if c in num]
    if missing is not None and strategy != "mean":
        has_null = {c for c in cols if missing.get(c)}
    else:
        row = base.agg(*aggs).first()  # one row: null counts (+ means)
        has_null = {c for i, c in enumerate(cols) if row[f"n{i}"]}
        for i, c in enumerate(zeros or {}):
            zeros[c] = row[f"z{i}"]
    need = (lambda c: c in has_null) if only_missing else (lambda c: True)
    if strategy == "mode":
        targets = [c for c in cols if need(c)]
        modes = column_modes(df, targets)
        default = fill_value if fill_value is not None else 0
        params.fills = {c: modes.get(c, default) for c in targets}
        return params
    for i, c in enumerate(cols):
        if c in num and need(c):
            if strategy == "mean":
                params.fills[c] = row[f"a{i}"]
            if (c in has_null or not only_missing) and isinstance(df.schema[c].dataType, INTEGRAL):
                params.widen.append(c)
    if strategy == "median":
        med_cols = [c for c in num if need(c)]
        if med_cols:
            from cadence.functions.quantiles import grouped_quantiles
            names = [f"m{j}" for j in range(len(med_cols))]
            meds = grouped_quantiles(base.select(*med_cols), [], med_cols, [0.5], exact=exact, names=names).first()
            for j, c in enumerate(med_cols):
                params.fills[c] = meds[f"m{j}"][0] if meds[f"m{j}"] is not None else None
    cat_targets = [c for c in cat if need(c)]
    modes = column_modes(df, cat_targets)
    for c in cat_targets:
        params.fills[c] = modes.get(c, "unknown")
    return params


def apply_missing(df: DataFrame, params: Imputation) -> DataFrame:
    if params.strategy == "drop":
        return drop_missing(df)
    if params.strategy == "fill":
        return fill_missing(df, params.fills["*"])
    df = nan_to_null(df, list(params.fills))
    out = {}
    for c, v in params.fills.items():
        if c not in df.columns:
            continue
        t = df.schema[c].dataType
        col = F.col(c).cast("double") if c in params.widen else F.col(c)
        if v is None:
            out[c] = col
        elif c in params.widen or isinstance(t, (T.FloatType, T.DoubleType)):
            out[c] = F.coalesce(col, F.lit(float(v)).cast(col_type(t, c in params.widen)))
        else:
            out[c] = F.coalesce(col, F.lit(v).cast(t))
    return df.withColumns(out)


def col_type(t: T.DataType, widened: bool) -> T.DataType:
    return T.DoubleType() if widened else t


def handle_missing_values(df: DataFrame, strategy: str = "mean", fill_value: Any = None,
                          exact: bool = True) -> DataFrame:
    """F01-F04 in one call (fit on this frame, then apply)."""
    return apply_missing(df, fit_missing(df, strategy, fill_value, exact=exact))
