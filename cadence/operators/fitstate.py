"""What fitting needs to know of a table, in a form that adds up over tables.

A `FitState` holds, for every numeric column, the counts of present, missing and zero values, mean, sum
of squared deviations, extremes and a KLL sketch (of all values, or, for columns whose zeros stand for
missing values, of the others), and for every categorical column the count of each value, as a
table. One aggregate and one grouping read the data; states of later batches are merged into it
without reading the earlier data again, and all fitted parameters (fill values, label codes, scaler)
follow from it: a fill value for every column, whether it had missing values so far or not.

Moments after filling have a closed form, since filling adds equal values: no pass over the
filled data is needed for the scaler.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.functions.columns import categorical_columns, is_missing, numeric_columns
from cadence.functions.quantiles import SKETCH, small_table
from cadence.operators.encode import INLINE_MAX

GRID = 2000   # steps of rank at which a sketch is read


@dataclass
class Moments:
    """Count, mean, sum of squared deviations and extremes of some values."""
    n: int = 0
    mean: float = 0.0
    m2: float = 0.0
    low: float | None = None
    high: float | None = None

    def merge(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, step = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + step * other.n / n, self.m2 + other.m2 + step * step * self.n * other.n / n,
                       min(self.low, other.low), max(self.high, other.high))

    @staticmethod
    def constant(n: int, value: float) -> Moments:
        return Moments(n, float(value), 0.0, float(value), float(value)) if n else Moments()


@dataclass
class ColumnState:
    present: int = 0
    missing: int = 0
    zeros: int = 0
    all: Moments = field(default_factory=Moments)
    nonzero: Moments | None = None   # of columns whose zeros stand for missing values
    sketch: bytes | None = None


@dataclass
class Head:
    size: int
    mode: str
    values: dict[str, int]


@dataclass
class FitState:
    numbers: dict[str, ColumnState]
    values: DataFrame                 # (column, value, n): categorical columns, and numeric ones on demand
    missing: dict[str, int]           # of the columns in ``values``
    zero_columns: list[str]
    _heads: dict[str, Head] | None = None

    def heads(self) -> dict[str, Head]:
        """Number of values, mode and the first `INLINE_MAX` values with their counts of every column that has a
        value: one job, remembered."""
        if self._heads is None:
            number = F.when(F.col("column").isin(list(self.numbers)), F.col("value").try_cast("double"))
            best = F.min_by("value", F.struct((-F.col("n")).alias("n"), number.alias("number"), F.col("value")))
            sizes = self.values.groupBy("column").agg(F.count(F.lit(1)).alias("size"), best.alias("mode"))
            first = F.row_number().over(Window.partitionBy("column").orderBy("value"))
            rows = self.values.withColumn("rank", first).where(F.col("rank") <= INLINE_MAX).join(sizes, "column").collect()
            self._heads = {}
            for r in rows:  # <= INLINE_MAX a column
                self._heads.setdefault(r["column"], Head(r["size"], r["mode"], {})).values[r["value"]] = r["n"]
        return self._heads

    def merge(self, other: FitState) -> FitState:
        """State of both tables together. Columns must be the same."""
        if set(self.numbers) != set(other.numbers) or set(self.missing) != set(other.missing) or self.zero_columns != other.zero_columns:
            raise ValueError("states of different columns cannot be merged")
        spark = self.values.sparkSession
        out, sketches = {}, [(c, s.numbers[c].sketch) for s in (self, other) for c in self.numbers if s.numbers[c].sketch]
        merged = {}
        if sketches:
            table = spark.createDataFrame([(c, bytearray(b)) for c, b in sketches], "column string, sketch binary")  # two rows a column
            merged = {r.column: bytes(r.sketch) for r in table.groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("sketch")).collect()}
        for c, a in self.numbers.items():
            b = other.numbers[c]
            out[c] = ColumnState(a.present + b.present, a.missing + b.missing, a.zeros + b.zeros, a.all.merge(b.all),
                                 a.nonzero.merge(b.nonzero) if a.nonzero is not None and b.nonzero is not None else None, merged.get(c))
        values = small_table(self.values.unionByName(other.values).groupBy("column", "value").agg(F.sum("n").alias("n")))
        return FitState(out, values, {c: n + other.missing[c] for c, n in self.missing.items()}, self.zero_columns)

    def medians(self, constants: dict[str, tuple[int, float]] | None = None) -> dict[str, float]:
        """Median, to the sketch's precision, of what each column's sketch has seen, together with
        ``constants``: {column: (how many, value)} of equal values beside it."""
        rows = [(c, bytearray(s.sketch)) for c, s in self.numbers.items() if s.sketch]
        if not rows:
            return {}
        table = self.values.sparkSession.createDataFrame(rows, "column string, sketch binary")  # one row a column
        n = F.kll_sketch_get_n_double("sketch")
        at = F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(np.linspace(0, 1, GRID + 1)))).alias("at")
        out = {}
        for r in table.select("column", n.alias("n"), at).collect():
            more, value = (constants or {}).get(r.column, (0, 0.0))
            below = bisect_left(r.at, value) / len(r.at) * r.n if r.n else 0
            half = (r.n + more) / 2
            if not half:
                continue
            inside = more and below < half <= below + more
            rank = half if half <= below or not more else half - more
            out[r.column] = value if inside else r.at[min(round(rank / r.n * GRID), GRID)]
        return out

    def write(self, path: str) -> None:
        spark = self.values.sparkSession
        self.values.write.mode("overwrite").parquet(f"{path}/values")
        rows = [(c, json.dumps({k: v for k, v in asdict(s).items() if k != "sketch"}), bytearray(s.sketch) if s.sketch else None)
                for c, s in self.numbers.items()]
        rows.append((None, json.dumps({"missing": self.missing, "zero_columns": self.zero_columns}), None))
        spark.createDataFrame(rows, "column string, state string, sketch binary").write.mode("overwrite").parquet(f"{path}/numbers")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> FitState:
        numbers, rest = {}, {}
        for r in spark.read.parquet(f"{path}/numbers").collect():  # one row a column
            state = json.loads(r.state)
            if r.column is None:
                rest = state
                continue
            moments = {k: Moments(**state.pop(k)) if state.get(k) else state.pop(k, None) for k in ("all", "nonzero")}
            numbers[r.column] = ColumnState(**state, **moments, sketch=bytes(r.sketch) if r.sketch else None)
        return cls(numbers, spark.read.parquet(f"{path}/values"), rest["missing"], rest["zero_columns"])


def fit_state(df: DataFrame, zero_columns: list[str] | None = None, counted: list[str] | None = None) -> FitState:
    """State of ``df``, sketches apart (see `add_sketches`): one aggregate for numbers, one grouping for values.
    ``counted`` lists numeric columns whose values are counted as well. NaN counts as missing."""
    num, cat = numeric_columns(df), categorical_columns(df)
    zero_columns = [c for c in zero_columns or [] if c in num]
    aggs = [F.count_if(is_missing(df, c)).alias(f"v{i}") for i, c in enumerate(cat)]
    for i, c in enumerate(num):
        x = F.when(~is_missing(df, c), F.col(c).cast("double"))
        aggs += [F.count_if(is_missing(df, c)).alias(f"missing{i}"), F.count_if(x == 0).alias(f"zeros{i}")]
        for k, y in [("all", x)] + ([("nonzero", F.nullif(x, F.lit(0.0)))] if c in zero_columns else []):
            aggs += [F.count(y).alias(f"{k}_n{i}"), F.avg(y).alias(f"{k}_mean{i}"), F.var_pop(y).alias(f"{k}_var{i}"),
                     F.min(y).alias(f"{k}_low{i}"), F.max(y).alias(f"{k}_high{i}")]
    row = df.agg(*aggs).first() if aggs else None  # one row, a few numbers a column

    def moments_of(k: str, i: int) -> Moments:
        n = row[f"{k}_n{i}"]
        return Moments(n, row[f"{k}_mean{i}"], row[f"{k}_var{i}"] * n, row[f"{k}_low{i}"], row[f"{k}_high{i}"]) if n else Moments()

    numbers = {c: ColumnState(row[f"all_n{i}"], row[f"missing{i}"], row[f"zeros{i}"], moments_of("all", i),
                              moments_of("nonzero", i) if c in zero_columns else None) for i, c in enumerate(num)}
    of = [*cat, *(counted or [])]
    if of:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.when(~is_missing(df, c), F.col(c)).cast("string").alias("value"))
                                             for c in of])).alias("e")).select("e.*").where("value is not null")
        values = small_table(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    else:
        values = df.sparkSession.createDataFrame([], "column string, value string, n long")
    return FitState(numbers, values, {c: row[f"v{i}"] for i, c in enumerate(cat)}, zero_columns)


def add_sketches(state: FitState, df: DataFrame, columns: list[str]) -> FitState:
    """``state`` with the sketches of ``columns``, from one more aggregate over the table it was fitted on."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.when(~is_missing(df, c), F.col(c).cast("double"))
        aggs.append(F.kll_sketch_agg_double(F.nullif(x, F.lit(0.0)) if c in state.zero_columns else x, F.lit(SKETCH)).alias(f"s{i}"))
    row = df.agg(*aggs).first() if aggs else None
    for i, c in enumerate(columns):
        state.numbers[c].sketch = bytes(row[f"s{i}"])
    return state


def modes(state: FitState, columns: list[str]) -> dict[str, str]:
    """Most frequent value of each of ``columns``, the least among equals; absent without values.
    Numbers are compared as numbers."""
    heads = state.heads()
    return {c: heads[c].mode for c in columns if c in heads}
