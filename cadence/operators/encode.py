"""Categorical encoding: label codes (F05, F06), one-hot columns and one-hot vectors.

Label codes: distinct values (one shuffle of distinct values only) are ranked on the small
distinct table, never on rows. Applying the codes picks a plan by the checked code-table
size: an inline map literal (no join at all), a broadcast hash join, or - for very high
cardinality - a shuffle join. Nothing unbounded is ever broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.columns import categorical_columns
from cadence.functions.quantiles import small_table
from cadence.functions.ranking import global_rank

NULL_TOKEN = "None"          # string form a missing value takes before encoding (fixed value)
INLINE_MAX = 256             # code tables up to this size become a map literal
BROADCAST_MAX_ROWS = 200_000  # code tables broadcast up to this many rows


@dataclass
class LabelCodes:
    """Per column either an inline mapping (small) or a code DataFrame (value, code)."""
    inline: dict[str, dict[str, int]] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)


def _as_text(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN))


def fit_label_codes(df: DataFrame, columns: list[str] | None = None) -> LabelCodes:
    """One job for all columns: unpivot to (column, value), distinct (map-side combined, so
    the shuffle carries distinct values only), then per column the size and the first
    INLINE_MAX values in order (a window-group limit: top rows per task before the
    shuffle). Only columns beyond INLINE_MAX values get a code table."""
    cols = columns if columns is not None else categorical_columns(df)
    codes = LabelCodes()
    if not cols:
        return codes
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _as_text(c).alias("value")) for c in cols])).alias("kv")).select("kv.*")
    distinct = long.distinct()
    sizes = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    head = distinct.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy("value"))) \
                   .where(F.col("rank") <= INLINE_MAX)
    rows = head.join(sizes, "column").collect()  # <= INLINE_MAX rows per column
    by_col: dict[str, dict[str, int]] = {c: {} for c in cols}
    for r in rows:
        codes.sizes[r["column"]] = r["n"]
        by_col[r["column"]][r["value"]] = r["rank"] - 1
    for c in cols:
        n = codes.sizes.setdefault(c, 0)
        if n <= INLINE_MAX:
            codes.inline[c] = by_col[c]
            continue
        values = distinct.where(F.col("column") == c).select("value")
        if n <= BROADCAST_MAX_ROWS:
            # Ranking over <= BROADCAST_MAX_ROWS distinct values: one small task.
            codes.tables[c] = values.withColumn("code", (F.row_number().over(Window.orderBy("value")) - 1).cast("int"))
        else:
            # Distributed rank: range-partitioned sort plus per-partition offsets.
            codes.tables[c] = global_rank(values, ["value"], "code").withColumn("code", F.col("code").cast("int"))
    return codes


def _with_fills(counts: DataFrame, fills: dict[str, tuple]) -> DataFrame:
    """``counts`` (column, value, n) of the columns in ``fills``, with the missing values of each, {column:
    (fill, how many)}, counted as its fill; a column without any value has its fill alone."""
    spark = counts.sparkSession
    rows = [(c, str(v), int(n)) for c, (v, n) in fills.items()]  # one row a column
    more = spark.createDataFrame(rows, "column string, value string, n long")
    both = counts.where(F.col("column").isin(list(fills))).unionByName(more).groupBy("column", "value").agg(F.sum("n").alias("n"))
    any_value = F.max("n").over(Window.partitionBy("column"))
    return both.withColumn("__any", any_value).where((F.col("n") > 0) | (F.col("__any") == 0)).drop("__any")


def codes_from_counts(counts: DataFrame, fills: dict[str, tuple], heads: dict | None = None) -> tuple[LabelCodes, dict[str, tuple]]:
    """Label codes from the counts of values, and (n, mean, sum of squared deviations, least, greatest) of the
    codes of each column, the missing values filled. Only columns beyond INLINE_MAX values get a code table.
    ``heads`` has the size and the first values of each column where they are known (see `FitState.heads`)."""
    codes, moments = LabelCodes(), {}
    if heads is None:
        from cadence.operators.fitstate import FitState
        heads = FitState({}, counts, {}, []).heads()
    large = {}
    for c, (fill, missing) in fills.items():
        head = heads.get(c)
        values = dict(head.values) if head else {}
        if missing or not head:
            values[str(fill)] = values.get(str(fill), 0) + int(missing)
        if (head.size if head else 0) > INLINE_MAX or len(values) > INLINE_MAX:
            large[c] = (fill, missing)
            continue
        ordered = sorted(values)
        codes.inline[c], codes.sizes[c] = {v: i for i, v in enumerate(ordered)}, len(ordered)
        n = sum(values.values())
        mean = sum(i * values[v] for i, v in enumerate(ordered)) / n if n else 0.0
        moments[c] = (n, mean, sum(values[v] * (i - mean) ** 2 for i, v in enumerate(ordered)), 0.0, float(len(ordered) - 1))
    filled = _with_fills(counts, large) if large else None
    for c in large:
        mine = filled.where(F.col("column") == c).select("value", "n")
        table = small_table(global_rank(mine, ["value"], "code").withColumn("code", F.col("code").cast("int")))
        x, n = F.col("code").cast("double"), F.col("n").cast("double")
        m = table.agg(F.sum("n").alias("n"), (F.sum(x * n) / F.sum(n)).alias("mean"), F.max("code").alias("high")).first()
        m2 = table.agg(F.sum(n * (x - F.lit(m["mean"])) ** 2)).first()[0]
        moments[c], codes.sizes[c] = (m["n"], m["mean"], m2, 0.0, float(m["high"])), m["high"] + 1
        codes.tables[c] = table.select("value", "code")
    return codes, moments


def apply_label_codes(df: DataFrame, codes: LabelCodes, handle_unknown: str = "error") -> DataFrame:
    """Replace each fitted column by its integer code. Unseen values raise (``error``) or get
    -1 (``keep``)."""
    if handle_unknown not in ("error", "keep"):
        raise ValueError("handle_unknown must be 'error' or 'keep'")

    def finish(c: str, code):
        if handle_unknown == "keep":
            return F.coalesce(code, F.lit(-1))
        return F.coalesce(code, F.raise_error(F.concat(
            F.lit(f"y contains previously unseen labels in column {c}: "), _as_text(c)))).cast("int")

    out = df
    mapped = {}
    for c, m in codes.inline.items():
        lit_map = F.create_map(*[x for k, v in sorted(m.items()) for x in (F.lit(k), F.lit(v))])
        mapped[c] = finish(c, F.element_at(lit_map, _as_text(c)) if m else F.lit(None).cast("int"))
    if mapped:
        out = out.withColumns(mapped)
    for c, table in codes.tables.items():
        t = table.select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__code_{c}"))
        if codes.sizes[c] <= BROADCAST_MAX_ROWS:
            t = F.broadcast(t)
        out = (out.withColumn(f"__k_{c}", _as_text(c))
               .join(t, F.col(f"__k_{c}") == F.col(f"__v_{c}"), "left")
               .withColumn(c, finish(c, F.col(f"__code_{c}")))
               .drop(f"__k_{c}", f"__v_{c}", f"__code_{c}"))
    return out.select(*df.columns)


def label_encode(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """codes 0..k-1 in sorted order of the string form; NULL is encoded as ``"None"``."""
    return apply_label_codes(df, fit_label_codes(df, columns))


def code_table(codes: LabelCodes, spark) -> DataFrame:
    """Fitted codes as one long table (column, value, code) for persistence."""
    rows = [(c, v, i) for c, m in codes.inline.items() for v, i in m.items()]
    out = spark.createDataFrame(rows, "column string, value string, code int")
    for c, t in codes.tables.items():
        out = out.unionByName(t.select(F.lit(c).alias("column"), "value", "code"))
    return out


def load_codes(table: DataFrame) -> LabelCodes:
    """Codes back from a ``code_table``: small columns inline, large ones as tables."""
    codes = LabelCodes()
    for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per column
        c, n = r["column"], r["n"]
        codes.sizes[c] = n
        part = table.where(F.col("column") == c).select("value", "code")
        if n <= INLINE_MAX:
            codes.inline[c] = {x["value"]: x["code"] for x in part.collect()}
        else:
            codes.tables[c] = part
    return codes


def fit_categories(df: DataFrame, columns: list[str] | None = None,
                   max_categories: int = INLINE_MAX) -> dict[str, list[str]]:
    """F07 fit: the sorted categories of each column, under a checked cap on new columns."""
    out = {}
    for c in columns if columns is not None else categorical_columns(df):
        vals = df.select(F.col(c).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
        capped = vals.limit(max_categories + 1).collect()
        if len(capped) > max_categories:
            raise ValueError(f"column {c} has more than {max_categories} categories; "
                             "use one_hot_vectors instead")
        out[c] = sorted(r["v"] for r in capped)
    return out


def categories_from_counts(counts: DataFrame, fills: dict[str, tuple], max_categories: int = INLINE_MAX) -> dict[str, list[str]]:
    """Sorted categories of each column from the counts of its values, the missing ones filled."""
    filled = _with_fills(counts, fills) if fills else counts.limit(0)
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    out: dict[str, list[str]] = {c: [] for c in fills}
    for r in filled.withColumn("rank", rank).where(F.col("rank") <= max_categories + 1).collect():  # that many rows a column
        out[r["column"]].append(r["value"])
    for c, values in out.items():
        if len(values) > max_categories:
            raise ValueError(f"column {c} has more than {max_categories} categories; use label codes or one_hot_vectors instead")
    return {c: sorted(v) for c, v in out.items()}


def apply_categories(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """F07 apply: drop each column, append its boolean ``<col>_<value>`` columns; NULL and
    unseen values give all false."""
    keep = [F.col(x) for x in df.columns if x not in categories]
    return df.select(*keep, *[F.coalesce(F.col(c).cast("string") == F.lit(v), F.lit(False)).alias(f"{c}_{v}")
                              for c, cats in categories.items() for v in cats])


def one_hot(df: DataFrame, columns: list[str] | None = None, max_categories: int = INLINE_MAX) -> DataFrame:
    """fit and apply on one frame."""
    return apply_categories(df, fit_categories(df, columns, max_categories))


@dataclass
class OneHotVectors:
    """F07 in vector form: codes of each column's values, and how many there are."""
    codes: LabelCodes
    sizes: dict[str, int]


def fit_one_hot_vectors(df: DataFrame, columns: list[str] | None = None) -> OneHotVectors:
    """Codes of the values of each column, in sorted order, from one grouping; any number of categories."""
    cols = columns if columns is not None else categorical_columns(df)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("kv"))
    counts = small_table(long.select("kv.*").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    codes, _ = codes_from_counts(counts, {c: (NULL_TOKEN, 0) for c in cols})
    return OneHotVectors(codes, {c: codes.sizes[c] for c in cols})


def apply_one_hot_vectors(df: DataFrame, fitted: OneHotVectors) -> DataFrame:
    """Replace each fitted column by a sparse vector ``<col>_vector`` with a 1 at the place of its value; NULL and
    unseen values give a vector of zeros. A row carries one number a column, whatever the number of
    categories."""
    from pyspark.ml.feature import OneHotEncoder
    cols = list(fitted.sizes)
    null = [F.col(c).isNull().alias(f"__null_{c}") for c in cols]
    # The codes replace the columns, so whether a value was there is kept beside them.
    codes = apply_label_codes(df.select("*", *null), fitted.codes, "keep")
    out = codes.withColumns({f"__at_{c}": F.when(F.col(f"__null_{c}") | (F.col(c) < 0), n).otherwise(F.col(c)).cast("double")
                             for c, n in fitted.sizes.items()})
    # One more category than there are stands for none, and is the last one, which the encoder drops.
    sizes = df.sparkSession.createDataFrame([tuple(float(n) for n in fitted.sizes.values())], [f"__at_{c}" for c in cols])
    model = OneHotEncoder(inputCols=[f"__at_{c}" for c in cols], outputCols=[f"{c}_vector" for c in cols], dropLast=True).fit(sizes)
    keep = [c for c in df.columns if c not in cols]
    return model.transform(out).select(*keep, *[f"{c}_vector" for c in cols])


def one_hot_vectors(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """F07 in vector form: fit and apply on one frame."""
    return apply_one_hot_vectors(df, fit_one_hot_vectors(df, columns))
