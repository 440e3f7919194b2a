"""Reproducible splits.

Default: each row's split is a pure function of its key and the seed (md5 hash bucket), so
the split needs no shuffle, is stable under repartitioning / task retries, and matches the
DuckDB formula. ``exact=True`` cuts at exact counts in the (hash, key) order without a
global sort: rows are counted per coarse hash bucket (a tiny grouped aggregate), buckets
entirely inside a split are labelled directly, and only the rows of the at most two boundary
buckets per group are ranked (one written range placement, ``running_totals``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.hashing import hash32
from cadence.functions.ranking import join_null_safe, running_totals

RESOLUTION = 10_000        # hash-fraction granularity of the default split


def content_key(columns: list[str]) -> Column:
    """Row key for tables without one: a 64-bit hash of all columns. Identical rows share the
    key and therefore land in the same split (no train/test leakage of duplicates)."""
    return F.xxhash64(*[F.col(c) for c in columns]).cast("string")


def key_column(key: str | list[str]) -> Column:
    cols = [key] if isinstance(key, str) else list(key)
    if len(cols) == 1:
        return F.col(cols[0]).cast("string")
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def split_sizes(n: int, test_size: float, val_size: float) -> tuple[int, int, int]:
    """Exact sizes as in the reference: test = ceil(n*test), val = ceil(rest*val/(1-test))."""
    n_test = math.ceil(n * test_size) if test_size else 0
    rest = n - n_test
    n_val = math.ceil(rest * (val_size / (1 - test_size))) if val_size else 0
    return n - n_test - n_val, n_val, n_test


def hash_split(df: DataFrame, key: str | list[str], test_size: float = 0.2,
               val_size: float = 0.1, seed: int = 42, exact: bool = False,
               stratify_by: str | None = None, split_col: str = "split") -> DataFrame:
    """Adds ``split`` in {train, val, test}. Not stratified unless ``stratify_by``."""
    h = hash32(key_column(key), seed)
    if not exact:
        b = h % F.lit(RESOLUTION)
        t1 = round(test_size * RESOLUTION)
        t2 = round((test_size + val_size) * RESOLUTION)
        return df.withColumn(split_col, F.when(b < t1, "test").when(b < t2, "val").otherwise("train"))

    def sizes(n: Column) -> tuple[Column, Column]:  # split_sizes as expressions
        n_test = F.ceil(n.cast("double") * F.lit(float(test_size)))
        return n_test, F.ceil((n - n_test).cast("double") * F.lit(val_size / (1 - test_size)))
    return _exact_split(df, key, h, sizes, stratify_by, split_col)


def _exact_split(df, key, h, sizes, by, split_col):
    groups = [by] if by else []
    # A whole column has 65,536 coarse buckets, a stratum 1,024: counted, never collected.
    shift = 32 - (10 if by else 16)
    work = df.withColumn("__h", h).withColumn("__k", key_column(key)) \
             .withColumn("__cb", F.shiftright(F.col("__h"), shift).cast("int"))
    per_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    plan = work.groupBy(*groups, "__cb").agg(F.count(F.lit(1)).alias("__cn"))
    up_to = per_group.orderBy("__cb").rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.withColumn("__c0", F.sum("__cn").over(up_to) - F.col("__cn")).withColumn("__n", F.sum("__cn").over(per_group))
    n_test, n_val = sizes(F.col("__n"))
    plan = plan.withColumn("__t1", n_test).withColumn("__t2", n_test + n_val).drop("__n")
    # Without strata the plan has 65,536 rows at most: a proven bound. With strata its size
    # follows their number, and AQE decides by the size it turns out to have.
    tagged = join_null_safe(work, plan if by else F.broadcast(plan), [*groups, "__cb"])
    inside = ((F.col("__c0") + F.col("__cn") <= F.col("__t1")) |
              ((F.col("__c0") >= F.col("__t1")) & (F.col("__c0") + F.col("__cn") <= F.col("__t2"))) |
              (F.col("__c0") >= F.col("__t2")))

    def label(rank):
        return F.when(rank <= F.col("__t1"), "test").when(rank <= F.col("__t2"), "val").otherwise("train")

    direct = tagged.where(inside).withColumn(split_col, label(F.col("__c0") + 1))
    # At most two boundary buckets a group need row ranks, by (hash, key, content hash); a key
    # that holds a large share of the rows, or a row that does, still spreads over partitions.
    boundary = tagged.where(~inside).withColumn("__tb", F.xxhash64(*[F.col(c) for c in df.columns])).withColumn("__one", F.lit(1))
    ranked = running_totals(boundary, [*groups, "__cb"], ["__h", "__k", "__tb"], "__one")
    ranked = ranked.withColumn(split_col, label(F.col("__c0") + F.col("__before") + 1))
    drop = ["__h", "__k", "__cb", "__c0", "__t1", "__t2", "__cn"]
    return direct.unionByName(ranked.drop("__tb", "__one", "__before", "__total")).drop(*drop)


def train_val_split(df: DataFrame, key: str | list[str], val_split: float = 0.2, seed: int = 42,
                    exact: bool = False) -> DataFrame:
    """Two-way split; exact size of val = floor(n * val_split)."""
    if not exact:
        return hash_split(df, key, 0.0, val_split, seed)
    h = hash32(key_column(key), seed)
    return _exact_split(df, key, h, lambda n: (F.lit(0).cast("long"), F.floor(n.cast("double") * F.lit(float(val_split)))), None, "split")


def sample_rate_filter(df: DataFrame, key: str, rate: float, seed: int = 42) -> DataFrame:
    """Keep a sticky ``rate`` share of keys (shadow sampling)."""
    return df.where((hash32(F.col(key).cast("string"), seed) % F.lit(RESOLUTION)) < round(rate * RESOLUTION))


def dataset_shape(df: DataFrame, label: str) -> DataFrame:
    """Distinct class count and feature count of a training table."""
    return df.agg(F.count_distinct(label).cast("bigint").alias("num_classes")) \
             .withColumn("num_features", F.lit(len(df.columns) - 1).cast("bigint"))
