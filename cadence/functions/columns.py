"""Column helpers: type families (P01), missing-value predicates, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_FRACTIONAL = (T.FloatType, T.DoubleType)
_DATETIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def numeric_columns(df: DataFrame, include_bool: bool = False) -> list[str]:
    """Numeric family. ``include_bool=False`` is the numeric selection used for imputing and
    scaling; ``include_bool=True`` is the numeric test of schema validation (bool counts)."""
    types = _NUMERIC + ((T.BooleanType,) if include_bool else ())
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _DATETIME)]


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _FRACTIONAL)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN on float/double columns (both count as missing)."""
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if is_fractional(df, name) else c.isNull()


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Normalise NaN to NULL once, on the float/double columns."""
    cols = [c for c in (columns or df.columns) if is_fractional(df, c)]
    if not cols:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")).cast(
        df.schema[c].dataType) for c in cols})


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column (result presentation and oracle comparison)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _FRACTIONAL)]
    if not cols:
        return df
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})
