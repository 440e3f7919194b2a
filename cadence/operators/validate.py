"""Data validation and profiling.

One aggregate pass computes, for every column, the missing count, non-null count, min / max
(constant test without a distinct-count Expand), sample std of the listed numeric columns and
an approximate in-memory width. Duplicates are counted on 128-bit row hashes, so whole rows never
shuffle. Findings are a DataFrame
``(check, column, severity, value, threshold, message)``; the summary is one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.columns import categorical_columns, is_missing, nan_to_null, numeric_columns

FINDINGS_SCHEMA = ("check string, column string, severity string, value double, "
                   "threshold double, message string")
_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BinaryType)

# Fixed values of the reference's checks: warning above 10 % nulls, warning above 10 %
# duplicate rows, 100 minimum rows and 30 % maximum nulls by default.
NULL_WARNING_RATIO = 0.1
DUPLICATE_WARNING_RATIO = 0.1


@dataclass
class DataSchema:
    required_columns: list[str] = field(default_factory=list)
    numeric_columns: list[str] = field(default_factory=list)
    categorical_columns: list[str] = field(default_factory=list)
    target_column: str | None = None
    min_rows: int = 100
    max_null_ratio: float = 0.3

    def __post_init__(self):  # V16
        if not 0 <= self.max_null_ratio <= 1:
            raise ValueError("max_null_ratio must be between 0 and 1")


def _pct(x: float) -> str:
    return f"{x:.1%}"


def column_profile(df: DataFrame, std_columns: list[str] | None = None) -> dict:
    """One aggregate pass; returns a dict of per-column statistics (bounded by column count)."""
    base = nan_to_null(df)
    aggs = [F.count(F.lit(1)).alias("__n")]
    width = F.lit(0)
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs += [F.count_if(c.isNull()).alias(f"m{i}"), F.count(c).alias(f"c{i}")]
        if isinstance(f.dataType, _ORDERABLE):
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(c) + 49, F.lit(8))
        else:
            width = width + F.lit(8)
    for j, name in enumerate(std_columns or []):
        aggs.append(F.stddev_samp(F.col(name).cast("double")).alias(f"s{j}"))
    aggs.append(F.sum(width).alias("__bytes"))
    row = base.agg(*aggs).first().asDict()
    cols = {}
    for i, f in enumerate(df.schema.fields):
        lo, hi = row.get(f"lo{i}"), row.get(f"hi{i}")
        cols[f.name] = {
            "missing": row[f"m{i}"], "count": row[f"c{i}"], "dtype": f.dataType.simpleString(),
            "constant": row[f"c{i}"] > 0 and (f"lo{i}" in row) and lo == hi,
        }
    stds = {name: row[f"s{j}"] for j, name in enumerate(std_columns or [])}
    n = row["__n"]
    return {"n": n, "columns": cols, "std": stds,
            "memory_mb": ((row["__bytes"] or 0) + 128) / 1024 / 1024}


def duplicate_count(df: DataFrame) -> DataFrame:
    """V04 core: one row (n, duplicates). Rows are grouped by 128 bits of hash over all columns
    and their NULL flags (a 16-byte key, map-side combined, one scan); a row beyond the first of
    its group is a duplicate, NULLs being equal as in pandas. Two different rows of a
    trillion share 128 bits with a chance of 1e-15."""
    cols = [F.col(c) for c in df.columns]
    # A hash skips NULL columns, so the flags tell (1, NULL) from (NULL, 1).
    flags = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    per_row = df.groupBy(F.xxhash64(flags, *cols).alias("__h1"), F.xxhash64(F.lit("second"), flags, *cols).alias("__h2")) \
                .agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n"),
                       F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def duplicate_ratio(df: DataFrame) -> DataFrame:
    d = duplicate_count(df)
    return d.withColumn("duplicate_ratio", F.coalesce(
        F.try_divide(F.col("duplicates").cast("double"), F.col("n").cast("double")), F.lit(0.0)))


def null_profile(df: DataFrame, max_null_ratio: float = 0.3,
                 warn_ratio: float = NULL_WARNING_RATIO) -> DataFrame:
    """Per column null count / ratio and severity (error > max, else warning > 0.1)."""
    n = F.count(F.lit(1))
    exprs = [F.struct(F.lit(c).alias("column"), F.count_if(is_missing(df, c)).cast("bigint").alias("null_count"))
             for c in df.columns]
    long = df.agg(n.alias("__n"), F.array(*exprs).alias("__a")).select(
        "__n", F.explode("__a").alias("s")).select("s.column", "s.null_count", "__n")
    ratio = F.coalesce(F.try_divide(F.col("null_count").cast("double"), F.col("__n").cast("double")), F.lit(0.0))
    return long.select("column", "null_count", ratio.alias("null_ratio")).withColumn(
        "severity", F.when(F.col("null_ratio") > max_null_ratio, "error")
        .when(F.col("null_ratio") > warn_ratio, "warning").otherwise("ok"))


def numeric_summary(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, std (ddof 1), min, 25/50/75 % (linear interpolation), max.
    Quantiles are exact (``exact_quantiles``); ``exact=False`` takes fixed-size sketches."""
    from cadence.functions.quantiles import exact_quantiles
    cols = columns if columns is not None else numeric_columns(df)
    base = nan_to_null(df.select(*cols))
    probs = [0.25, 0.5, 0.75]
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        q = F.lit(None).cast("array<double>") if exact else F.percentile_approx(x, probs, 10000)
        structs.append(F.struct(F.lit(c).alias("column"), F.count(x).cast("bigint").alias("count"),
                                F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                                F.min(x).alias("min"), q.alias("q"), F.max(x).alias("max")))
    out = base.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    if exact:
        qt = exact_quantiles(base, cols, probs).select("column", F.col("quantiles").alias("__q"))
        out = out.drop("q").join(qt, "column", "left").withColumnRenamed("__q", "q")
    return out.select("column", "count", "mean", "std", "min",
                      F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """V10 + V11: per categorical column the distinct count and the k most frequent values
    (nulls excluded; ties by value ascending). ``row_number() <= k`` is planned as a
    window-group limit, so each task keeps only its top k per column before the shuffle."""
    cols = columns if columns is not None else categorical_columns(df)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    uniques = counts.groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("unique_values"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value").asc())
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.join(uniques, "column").withColumn("rank", F.col("rank").cast("int"))


def compute_statistics(df: DataFrame) -> dict:
    """V07 + V08: rows, columns, estimated memory (MB), null counts, dtypes."""
    p = column_profile(df)
    return {"num_rows": p["n"], "num_columns": len(df.columns), "memory_usage_mb": p["memory_mb"],
            "null_counts": {c: v["missing"] for c, v in p["columns"].items()},
            "dtypes": {c: v["dtype"] for c, v in p["columns"].items()}}


def findings(df: DataFrame, schema: DataSchema | None = None) -> tuple[DataFrame, dict]:
    """V01-V06 + V12: every check runs (no short-circuit); returns (findings, profile)."""
    schema = schema or DataSchema()
    spark = df.sparkSession
    present = set(df.columns)
    numeric_like = set(numeric_columns(df, include_bool=True))
    rows = []
    missing = sorted(set(schema.required_columns) - present)
    if missing:
        rows.append(("schema", ",".join(missing), "error", float(len(missing)), None,
                     "Missing required columns: {" + ", ".join(repr(m) for m in missing) + "}"))
    for c in schema.numeric_columns:
        if c in present and c not in numeric_like:
            rows.append(("schema", c, "error", None, None,
                         f"Column {c} should be numeric but is {df.schema[c].dataType.simpleString()}"))
    if schema.target_column and schema.target_column not in present:
        rows.append(("schema", schema.target_column, "error", None, None,
                     f"Target column '{schema.target_column}' not found"))
    std_cols = [c for c in schema.numeric_columns if c in present and c in numeric_like]
    prof = column_profile(df, std_cols)
    n = prof["n"]
    for c, s in prof["columns"].items():
        ratio = s["missing"] / n if n else 0.0
        if ratio > schema.max_null_ratio:
            rows.append(("null_ratio", c, "error", ratio, schema.max_null_ratio,
                         f"Column '{c}' has {_pct(ratio)} null values (max: {_pct(schema.max_null_ratio)})"))
        elif ratio > NULL_WARNING_RATIO:
            rows.append(("null_ratio", c, "warning", ratio, NULL_WARNING_RATIO,
                         f"Column '{c}' has {_pct(ratio)} null values"))
    if n < schema.min_rows:
        rows.append(("min_rows", None, "error", float(n), float(schema.min_rows),
                     f"Insufficient data: {n} rows (minimum: {schema.min_rows})"))
    d = duplicate_count(df).first()
    dup_ratio = d["duplicates"] / d["n"] if d["n"] else 0.0
    if dup_ratio > DUPLICATE_WARNING_RATIO:
        rows.append(("duplicates", None, "warning", dup_ratio, DUPLICATE_WARNING_RATIO,
                     f"Data has {_pct(dup_ratio)} duplicate rows"))
    for c, s in prof["columns"].items():
        if s["constant"]:
            rows.append(("constant", c, "warning", None, None, f"Column '{c}' has constant value"))
    for c in schema.numeric_columns:
        if c in present and c not in numeric_like:
            continue  # reported as a schema error; no std on a non-numeric column
        if c in prof["std"] and prof["std"][c] == 0:
            rows.append(("zero_variance", c, "warning", 0.0, 0.0, f"Column '{c}' has zero variance"))
    prof["duplicate_ratio"] = dup_ratio
    prof["checks_run"] = 3 + 2 * len(df.columns) + len(schema.numeric_columns) + 1
    return spark.createDataFrame(rows, FINDINGS_SCHEMA), prof


def validate(df: DataFrame, schema: DataSchema | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, summary). Summary: is_valid, num_samples, num_features, n_errors,
    n_warnings, quality_score (= passed checks / run checks, V14)."""
    f, prof = findings(df, schema)
    counts = f.agg(F.count_if(F.col("severity") == "error").cast("bigint").alias("n_errors"),
                   F.count_if(F.col("severity") == "warning").cast("bigint").alias("n_warnings"))
    summary = counts.select(
        (F.col("n_errors") == 0).alias("is_valid"),
        F.lit(prof["n"]).cast("bigint").alias("num_samples"),
        F.lit(len(df.columns)).cast("bigint").alias("num_features"),
        "n_errors", "n_warnings",
        (F.lit(1.0) - (F.col("n_errors") + F.col("n_warnings")) / F.lit(float(prof["checks_run"])))
        .alias("quality_score"))
    return f, summary


def quality_gate(summary: DataFrame, min_score: float = 0.8) -> DataFrame:
    """Proceed when valid and quality_score >= min_score."""
    return summary.withColumn("proceed", F.col("is_valid") & (F.col("quality_score") >= min_score))


def validate_splits(df: DataFrame, key: str | list[str], split_col: str = "split") -> DataFrame:
    """Per split row count and rows with any NULL feature; plus the number of keys that
    occur in more than one split (must be 0)."""
    keys = [key] if isinstance(key, str) else list(key)
    feats = [c for c in df.columns if c not in keys + [split_col]]
    any_null = None
    for c in feats:
        m = is_missing(df, c)
        any_null = m if any_null is None else (any_null | m)
    per = df.groupBy(split_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(any_null if any_null is not None else F.lit(False)).cast("bigint").alias("rows_with_nulls"))
    shared = (df.groupBy(*keys).agg(F.count_distinct(split_col).alias("__n_splits")).where(F.col("__n_splits") > 1)
              .count())  # one number
    return per.withColumn("shared_keys", F.lit(shared).cast("bigint")).withColumn(
        "valid", (F.col("rows_with_nulls") == 0) & (F.col("shared_keys") == 0))


def validate_training_data(spark, path: str, schema: DataSchema | None = None) -> tuple[DataFrame, DataFrame]:
    """Validate a directory (Parquet + CSV files), a ``.parquet`` or a ``.csv`` path;
    anything else (or an empty directory) is an invalid result with one error finding."""
    import os

    from cadence.sources.readers import read_mixed_directory, read_source

    def invalid(msg: str):
        f = spark.createDataFrame([("source", None, "error", None, None, msg)], FINDINGS_SCHEMA)
        s = spark.createDataFrame([(False, 0, 0, 1, 0, 0.0)], "is_valid boolean, num_samples bigint, "
                                  "num_features bigint, n_errors bigint, n_warnings bigint, quality_score double")
        return f, s
    ext = os.path.splitext(path.rstrip("/"))[1]
    if not ext:
        df = read_mixed_directory(spark, path)
        if df is None:
            return invalid("No data files found in directory")
    elif ext in (".parquet", ".csv"):
        df = read_source(spark, path)
    else:
        return invalid(f"Unsupported file format: {ext}")
    return validate(df, schema)
