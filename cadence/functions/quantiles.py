"""Exact quantiles by bracket and refine, and ranges of equal size, by one method for every size.

A first pass takes counts and a fixed-size KLL sketch of every column. The values that the sketch has at
slightly lower and slightly higher ranks bracket each wanted order statistic: they are three times as far
off as the sketch's error is in 99 of 100 cases, which a miss of the bracket has a chance of 1e-14 to
exceed (and would raise an error, not give a wrong value). A second pass counts what lies between the brackets and keeps only the values
inside them, a few thousandths of a large column, each with its count. These are cut into slots of
equal width; the totals of the slots tell which slots hold the wanted ranks, and only those are sorted,
each by itself. Interpolation is linear (the definition of ``percentile``, ``quantile_cont`` and
NumPy's default). NULL and NaN count as missing. No rows are placed or written; a value that many rows
hold is one row.

``exact=False`` gives the sketch's own quantiles instead.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from cadence.functions.ranking import join_null_safe
from cadence.session import scratch_path

SKETCH = 5000       # size of the sketch: its rank error is 2.296 / SKETCH**0.9021 in 99 of 100 cases
SLOTS = 1024        # parts of a bracket
#: (least rows, half the width of a bracket as a share of the rows): three times the sketch's error, or
#: four rows where that is more. With fewer rows than in the last line all values are kept.
WIDTHS = [(2000, 3 * 2.296 / SKETCH ** 0.9021), (400, 0.01), (80, 0.05)]


def _present(c: str) -> Column:
    """The column as double, NULL where it is NULL or NaN."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _quantiles_of(x: Column, ranks: np.ndarray) -> Column:
    """Values at ``ranks`` by a KLL sketch; NULL without a value."""
    sketch = F.kll_sketch_agg_double(x, F.lit(SKETCH))
    return F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(ranks)))


def _sketch(column: str, probs: list[float]) -> list[Column]:
    """Count of present values, and the sketch at the ends of the brackets of every width."""
    at = np.array([min(max(p + side * w, 0.0), 1.0) for _, w in WIDTHS for p in probs for side in (-1, 1)])
    x = _present(column)
    return [F.count(x).cast("bigint").alias("n"), _quantiles_of(x, at).alias("at")]


def _brackets(n: Column, at: Column, probs: int) -> tuple[list[Column], list[Column]]:
    """Ends of the brackets, by the width that suits the number of rows."""
    def end(side: int, i: int, whole: float) -> Column:
        out = F.lit(whole)
        for k, (least, _) in reversed(list(enumerate(WIDTHS))):
            out = F.when(n >= least, at[(k * probs + i) * 2 + side]).otherwise(out)
        return out
    return [end(0, i, float("-inf")) for i in range(probs)], [end(1, i, float("inf")) for i in range(probs)]


def _ends(sketch: Row, probs: int) -> tuple[list[float], list[float]]:
    """The same of a row that has been read."""
    k = next((k for k, (least, _) in enumerate(WIDTHS) if sketch["n"] >= least), None)
    if k is None:
        return [float("-inf")] * probs, [float("inf")] * probs
    at = [sketch["at"][(k * probs + i) * 2:(k * probs + i) * 2 + 2] for i in range(probs)]
    return [x for x, _ in at], [x for _, x in at]


def small_table(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that the planner knows its size and
    broadcasts it only if it is small. For tables with a row per group."""
    path = scratch_path(df.sparkSession, f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _summarised(df: DataFrame, aggs: list, columns: list[str], probs: list[float], g: list[str]) -> DataFrame | Row:
    """First pass: ``aggs`` and a struct __s{i} of count and sketch for every column; a table with groups, else its
    only row."""
    sketches = [F.struct(*_sketch(c, probs)).alias(f"__s{i}") for i, c in enumerate(columns)]
    if g:
        return small_table(df.groupBy(*g).agg(*aggs, *sketches))
    return df.agg(*aggs, *sketches).first()


def _refined(df: DataFrame, first: DataFrame | Row, columns: list[str], probs: list[float], g: list[str]) -> DataFrame:
    """Second pass: (groups..., column, n, quantiles) from the brackets of the first."""
    k = len(probs)
    ordered = sorted(range(k), key=lambda i: probs[i])  # brackets in ascending order
    sorted_probs = [probs[i] for i in ordered]
    places = [ordered.index(i) for i in range(k)]
    values = (df.select(*g, F.posexplode(F.array(*[_present(c) for c in columns])).alias("__i", "__v"))
              .where(F.col("__v").isNotNull()))
    if g:
        lows, highs = _brackets(F.col("__s.n"), F.col("__s.at"), k)
        brackets = (first.select(*g, F.posexplode(F.array(*[f"__s{i}" for i in range(len(columns))])).alias("__i", "__s"))
                    .select(*g, "__i", F.col("__s.n").alias("__n"), *[lows[i].alias(f"__low{j}") for j, i in enumerate(ordered)],
                            *[highs[i].alias(f"__high{j}") for j, i in enumerate(ordered)]))
        rows = join_null_safe(values, brackets, [*g, "__i"], "inner")
    else:  # a number for each column, looked up by its place
        ends = [_ends(first[f"__s{i}"], k) for i in range(len(columns))]
        place = lambda x, kind: F.get(F.lit(np.array(x, dtype=kind)), F.col("__i"))
        rows = values.select("__i", "__v", place([first[f"__s{i}"]["n"] for i in range(len(columns))], np.int64).alias("__n"),
                             *[place([e[side][i] for e in ends], np.float64).alias(f"__{name}{j}")
                               for j, i in enumerate(ordered) for side, name in ((0, "low"), (1, "high"))])
    # Buckets ascend: what lies before the first bracket, the first bracket's slots, what lies between, and so on.
    v, bucket, inside = F.col("__v"), F.lit(k * (SLOTS + 1)), F.lit(False)
    for j in range(k - 1, -1, -1):
        low, high = F.col(f"__low{j}"), F.col(f"__high{j}")
        share = F.try_divide(v - low, high - low)
        slot = F.coalesce(F.when(~F.isnan(share), F.least(F.floor(share * SLOTS), F.lit(SLOTS - 1))), F.lit(0)).cast("int")
        bucket = F.when(v > high, bucket).when(v >= low, j * (SLOTS + 1) + 1 + slot).otherwise(j * (SLOTS + 1))
        inside = inside | ((v >= low) & (v <= high))
    counts = (rows.select(*g, "__i", "__n", bucket.alias("__bucket"), F.when(inside, v).alias("__v"))
              .groupBy(*g, "__i", "__n", "__bucket", "__v").agg(F.count(F.lit(1)).alias("__c")))

    ranks = [(F.col("__n") - 1) * F.lit(float(p)) for p in sorted_probs]

    def holds(rank, first_, size):
        return (first_ <= rank) & (rank < first_ + size)

    def wanted(first_, size):
        out = F.lit(False)
        for r in ranks:
            out = out | holds(F.floor(r), first_, size) | holds(F.ceil(r), first_, size)
        return out

    by_column = Window.partitionBy(*g, "__i").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    totals = (counts.groupBy(*g, "__i", "__n", "__bucket").agg(F.sum("__c").alias("__size"))
              .withColumn("__before", F.sum("__size").over(by_column) - F.col("__size"))
              .where(wanted(F.col("__before"), F.col("__size"))))
    # Between brackets no wanted rank can lie, as long as the sketch keeps its bound.
    sure = F.when(F.col("__bucket") % (SLOTS + 1) == 0, F.raise_error(F.lit("a quantile lies outside its bracket"))).otherwise(F.col("__before"))
    totals = totals.select(*g, "__i", "__bucket", sure.cast("long").alias("__before"))
    kept = join_null_safe(counts.where(F.col("__v").isNotNull()), totals, [*g, "__i", "__bucket"], "inner")
    in_slot = Window.partitionBy(*g, "__i", "__bucket").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = kept.withColumn("__first", F.col("__before") + F.sum("__c").over(in_slot) - F.col("__c")).where(wanted(F.col("__first"), F.col("__c")))
    picked = ranked.groupBy(*g, "__i", "__n").agg(*[
        F.max(F.when(holds(f(r), F.col("__first"), F.col("__c")), F.col("__v"))).alias(f"__{side}{j}")
        for j, r in enumerate(ranks) for side, f in (("a", F.floor), ("b", F.ceil))])
    q = []
    for j, r in enumerate(ranks):
        a, b, part = F.col(f"__a{j}"), F.col(f"__b{j}"), r - F.floor(r)
        q.append(F.when(part == 0, a).otherwise(a + part * (b - a)))
    names = F.array(*[F.lit(c) for c in columns])
    return picked.select(*g, names[F.col("__i")].alias("column"), F.col("__n").cast("bigint").alias("n"),
                         F.array(*[q[j] for j in places]).alias("quantiles"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    groups: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """(groups..., column, n, quantiles array<double> in ``probs`` order), one row for every
    (group, column) that has a value. ``df`` is read twice: pass a scan or a written table
    (``partitions`` deals it anew first)."""
    g = list(groups or [])
    df = df.repartition(partitions) if partitions else df
    return _refined(df, _summarised(df, [], columns, probs, g), columns, probs, g)


def grouped_quantiles(df: DataFrame, aggs: list, value_cols: list[str], probs: list[float],
                      groups: list[str] | None = None, exact: bool = True,
                      names: list[str] | None = None) -> DataFrame:
    """``df.groupBy(groups).agg(*aggs)`` plus one quantile array per value column (named
    ``names``; NULL for a group without values). ``df`` is read twice, once for ``aggs`` and the
    sketches together: pass a written table or a scan, not an unwritten join."""
    g = list(groups or [])
    names = names or [f"q_{c}" for c in value_cols]
    if not exact:
        sketch = [F.percentile_approx(_present(c), [float(p) for p in probs], 10000).alias(n) for c, n in zip(value_cols, names)]
        return df.groupBy(*g).agg(*aggs, *sketch)
    first = _summarised(df, aggs, value_cols, probs, g)
    wide = _refined(df, first, value_cols, probs, g).groupBy(*g).agg(
        *[F.max(F.when(F.col("column") == c, F.col("quantiles"))).alias(n) for c, n in zip(value_cols, names)])
    if g:
        return join_null_safe(first.drop(*[f"__s{i}" for i in range(len(value_cols))]), wide, g)
    if not aggs:
        return wide
    # One row on both sides: what has been read stands beside the quantiles as literals.
    types = df.groupBy().agg(*aggs).schema
    return wide.select(*[F.lit(first[f.name]).cast(f.dataType).alias(f.name) for f in types], *names)


def equal_ranges(df: DataFrame, value: str, groups: list[str] | None = None, rows_each: int = 1_000_000, out: str = "range") -> DataFrame:
    """``df`` with the number of the range that ``value`` lies in: ascending ranges of about ``rows_each`` rows,
    as many (1 to 4,096, a power of two) as the largest group asks for. Bounds come from a sketch (one pass, off by a
    thousandth of the rows); equal values share a range, whatever their number. NULL and NaN get range 0."""
    g, grid = list(groups or []), 4096
    x = _present(value)
    sizes = df.groupBy(*g).agg(F.count(x).alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    steps = min((-(-most // rows_each) - 1).bit_length() if most else 0, 12)
    if not steps:
        return df.withColumn(out, F.lit(0))
    bounds = _quantiles_of(x, np.arange(1, grid) / grid).alias("__bounds")
    if g:
        df = join_null_safe(df, small_table(df.groupBy(*g).agg(bounds)), g)
    else:
        df = df.withColumn("__bounds", F.lit(np.array(df.agg(bounds).first()[0])))
    # Binary search for the number of bounds below the value, a step a projection, by every ``stride``-th bound.
    stride, keep = grid >> steps, [F.col(c) for c in df.columns if c != "__bounds"]
    df = df.select(*keep, "__bounds", x.alias("__x"), F.lit(0).alias(out))
    for k in range(steps - 1, -1, -1):
        bound = F.get("__bounds", (F.col(out) + (1 << k)) * stride - 1)
        df = df.select(*keep, "__bounds", "__x", F.when(F.col("__x") > bound, F.col(out) + (1 << k)).otherwise(F.col(out)).alias(out))
    return df.drop("__x", "__bounds")
