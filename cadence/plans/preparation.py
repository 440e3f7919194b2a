"""Preprocessing queries (P07-P09, F01-F15, D01-D05) over lineitem, orders, customer, part, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.columns import round_doubles
from cadence.operators.prepare import prepare
from cadence.plans.catalog import query
from cadence.tables import table

LINE_FEATURES = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus"]
SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


def _hash_case(key_sql: str, t1: int, t2: int) -> str:
    h = f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':42'), 1, 8))::BIGINT % 10000)"
    return f"CASE WHEN {h} < {t1} THEN 'test' WHEN {h} < {t2} THEN 'val' ELSE 'train' END"


_PREP_SQL = f"""
WITH base AS (
  SELECT l_orderkey, l_quantity, l_extendedprice, NULLIF(l_discount, 0) AS l_discount,
         NULLIF(l_tax, 0) AS l_tax, l_returnflag, l_linestatus
  FROM lineitem),
med AS (SELECT quantile_cont(l_discount, 0.5) AS md, quantile_cont(l_tax, 0.5) AS mt FROM base),
imp AS (
  SELECT b.l_orderkey, b.l_quantity, b.l_extendedprice,
         COALESCE(b.l_discount, m.md) AS l_discount, COALESCE(b.l_tax, m.mt) AS l_tax,
         DENSE_RANK() OVER (ORDER BY COALESCE(b.l_returnflag, 'None')) - 1 AS l_returnflag,
         DENSE_RANK() OVER (ORDER BY COALESCE(b.l_linestatus, 'None')) - 1 AS l_linestatus
  FROM base b CROSS JOIN med m),
st AS (
  SELECT avg(l_quantity) aq, stddev_pop(l_quantity) sq, avg(l_extendedprice) ae,
         stddev_pop(l_extendedprice) se, avg(l_discount) ad, stddev_pop(l_discount) sd,
         avg(l_tax) atx, stddev_pop(l_tax) stx, avg(l_returnflag) ar, stddev_pop(l_returnflag) sr
  FROM imp),
sc AS (
  SELECT (l_quantity - aq) / CASE WHEN sq = 0 THEN 1 ELSE sq END AS q,
         (l_extendedprice - ae) / CASE WHEN se = 0 THEN 1 ELSE se END AS e,
         (l_discount - ad) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS d,
         (l_tax - atx) / CASE WHEN stx = 0 THEN 1 ELSE stx END AS t,
         (l_returnflag - ar) / CASE WHEN sr = 0 THEN 1 ELSE sr END AS r,
         l_linestatus,
         {_hash_case('l_orderkey', 1500, 3000)} AS split
  FROM imp CROSS JOIN st)
SELECT split, CAST(count(*) AS BIGINT) AS n,
       round(avg(q), 6) AS mean_l_quantity, round(stddev_samp(q), 6) AS std_l_quantity,
       round(avg(e), 6) AS mean_l_extendedprice, round(stddev_samp(e), 6) AS std_l_extendedprice,
       round(avg(d), 6) AS mean_l_discount, round(stddev_samp(d), 6) AS std_l_discount,
       round(avg(t), 6) AS mean_l_tax, round(stddev_samp(t), 6) AS std_l_tax,
       round(avg(r), 6) AS mean_l_returnflag, round(stddev_samp(r), 6) AS std_l_returnflag,
       round(avg(l_linestatus), 6) AS positive_rate
FROM sc GROUP BY split
"""


def prepared_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINE_FEATURES)
    out, tgt, _ = prepare(li, key="l_orderkey", target="l_linestatus",
                          zero_as_missing_columns=["l_discount", "l_tax"])
    return out, tgt


@query("prepare_features", "F15 P07 F02 F05 F08 D01 J04", _PREP_SQL)
def prepare_features(spark, sf_dir):
    """Flagship: full prepare pipeline on lineitem, summarised per split."""
    out, tgt = prepared_lineitem(spark, sf_dir)
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in SCALED:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    aggs.append(F.avg(tgt).alias("positive_rate"))
    return round_doubles(out.groupBy("split").agg(*aggs))


# ----------------------------------------------------------------------------------------
# Imputation

from cadence.operators.encode import label_encode, one_hot  # noqa: E402
from cadence.operators.features import create_features  # noqa: E402
from cadence.operators.impute import (drop_missing, fill_missing, handle_missing_values,  # noqa: E402
                                      zero_as_missing)
from cadence.operators.scale import minmax_scale, standard_scale  # noqa: E402
from cadence.operators.split import (dataset_shape, hash_split, sample_rate_filter,  # noqa: E402
                                     train_val_split)


def sql_hash(key_sql: str, mod: int = 10000) -> str:
    return f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':42'), 1, 8))::BIGINT % {mod})"


@query("zero_as_missing_median", "P07 F02", """
WITH b AS (SELECT l_returnflag, NULLIF(l_discount, 0) AS d, NULLIF(l_tax, 0) AS t FROM lineitem),
m AS (SELECT quantile_cont(d, 0.5) AS md, quantile_cont(t, 0.5) AS mt FROM b)
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE d IS NULL) AS BIGINT) AS imputed_discount,
       round(avg(COALESCE(d, md)), 6) AS mean_discount, round(avg(COALESCE(t, mt)), 6) AS mean_tax,
       round(max(md), 6) AS median_discount, round(max(mt), 6) AS median_tax
FROM b CROSS JOIN m GROUP BY l_returnflag""")
def q_zero_as_missing_median(spark, sf_dir):
    from cadence.operators.impute import apply_missing, fit_missing
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_discount", "l_tax")
    z = zero_as_missing(li, ["l_discount", "l_tax"])
    fitted = fit_missing(z, "median")
    imp = apply_missing(z.withColumn("__was_null", F.col("l_discount").isNull()), fitted)
    return round_doubles(imp.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("__was_null").cast("bigint").alias("imputed_discount"),
        F.avg("l_discount").alias("mean_discount"), F.avg("l_tax").alias("mean_tax"))
        .withColumn("median_discount", F.lit(fitted.fills["l_discount"]))
        .withColumn("median_tax", F.lit(fitted.fills["l_tax"])))


def _customer_with_gaps(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_nationkey",
                    F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(F.col("c_acctbal") <= 9000, F.col("c_mktsegment")).alias("c_mktsegment"))


_CUST_GAPS = """c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
              CASE WHEN c_acctbal <= 9000 THEN c_mktsegment END AS c_mktsegment FROM customer)"""


@query("impute_mean", "F01 P01", f"""
WITH {_CUST_GAPS},
f AS (SELECT avg(c_acctbal) AS mb FROM c),
mo AS (SELECT c_mktsegment AS ms FROM c WHERE c_mktsegment IS NOT NULL
       GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT COALESCE(c_mktsegment, ms) AS c_mktsegment, CAST(count(*) AS BIGINT) AS n,
       round(sum(COALESCE(c_acctbal, mb)), 6) AS sum_acctbal
FROM c CROSS JOIN f CROSS JOIN mo GROUP BY 1""")
def q_impute_mean(spark, sf_dir):
    imp = handle_missing_values(_customer_with_gaps(spark, sf_dir), "mean")
    return round_doubles(imp.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("sum_acctbal")))


@query("impute_mode", "F03", f"""
WITH {_CUST_GAPS},
mb AS (SELECT c_acctbal AS v FROM c WHERE c_acctbal IS NOT NULL GROUP BY c_acctbal ORDER BY count(*) DESC, c_acctbal LIMIT 1),
ms AS (SELECT c_mktsegment AS v FROM c WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT COALESCE(c_mktsegment, ms.v) AS c_mktsegment, CAST(count(*) AS BIGINT) AS n,
       round(sum(COALESCE(c_acctbal, mb.v)), 6) AS sum_acctbal,
       round(max(mb.v), 6) AS mode_acctbal
FROM c CROSS JOIN mb CROSS JOIN ms GROUP BY 1""")
def q_impute_mode(spark, sf_dir):
    from cadence.operators.impute import fit_missing, apply_missing
    df = _customer_with_gaps(spark, sf_dir)
    p = fit_missing(df, "mode")
    return round_doubles(apply_missing(df, p).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("sum_acctbal"))
        .withColumn("mode_acctbal", F.lit(p.fills["c_acctbal"])))


@query("drop_nulls", "P08", f"""
WITH {_CUST_GAPS}
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, round(sum(c_acctbal), 6) AS sum_acctbal
FROM c WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY 1""")
def q_drop_nulls(spark, sf_dir):
    d = drop_missing(_customer_with_gaps(spark, sf_dir))
    return round_doubles(d.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("c_acctbal").alias("sum_acctbal")))


@query("fill_constant", "P09 F04", f"""
WITH {_CUST_GAPS}
SELECT COALESCE(c_mktsegment, '0') AS c_mktsegment, CAST(count(*) AS BIGINT) AS n,
       round(sum(COALESCE(c_acctbal, 0)), 6) AS sum_acctbal,
       CAST(count(*) FILTER (WHERE c_acctbal IS NULL) AS BIGINT) AS zero_filled
FROM c GROUP BY 1""")
def q_fill_constant(spark, sf_dir):
    df = _customer_with_gaps(spark, sf_dir).withColumn("__gap", F.col("c_acctbal").isNull())
    f = fill_missing(df, 0)
    return round_doubles(f.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("sum_acctbal"),
        F.count_if("__gap").cast("bigint").alias("zero_filled")))


# ----------------------------------------------------------------------------------------
# Encoding, scaling, features

@query("label_encode", "F05 F06", """
SELECT CAST(DENSE_RANK() OVER (ORDER BY COALESCE(o_orderpriority, 'None')) - 1 AS INTEGER) AS o_orderpriority,
       CAST(DENSE_RANK() OVER (ORDER BY COALESCE(o_orderstatus, 'None')) - 1 AS INTEGER) AS o_orderstatus,
       o_orderkey
FROM orders""")
def q_label_encode(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus", "o_orderkey")
    return label_encode(o, ["o_orderpriority", "o_orderstatus"])


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot_vectors", "F07", """
SELECT CAST(o_custkey AS VARCHAR) AS category, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1""")
def q_one_hot_vectors(spark, sf_dir):
    """Sparse one-hot vectors of the customers of orders, added up: one count for each of many categories."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    from cadence.operators.encode import apply_one_hot_vectors, code_table, fit_one_hot_vectors
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("o_custkey"))
    fitted = fit_one_hot_vectors(o)
    sums = apply_one_hot_vectors(o, fitted).agg(Summarizer.sum(F.col("o_custkey_vector")).alias("v"))
    counts = sums.select(F.posexplode(vector_to_array("v")).alias("code", "n"))
    return (counts.join(code_table(fitted.codes, spark), "code")
            .select(F.col("value").alias("category"), F.col("n").cast("bigint").alias("n")))


@query("one_hot", "F07", "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, " + ", ".join(
    f"CAST(sum(CAST(COALESCE(o_orderpriority = '{p}', false) AS INTEGER)) AS BIGINT) AS \"o_orderpriority_{p}\""
    for p in _PRIOS) + " FROM orders GROUP BY o_orderstatus")
def q_one_hot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    oh = one_hot(o, ["o_orderpriority"])
    cols = [c for c in oh.columns if c.startswith("o_orderpriority_")]
    return oh.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                            *[F.sum(F.col(c).cast("int")).cast("bigint").alias(c) for c in cols])


@query("standard_scale", "F08 F09", """
WITH s AS (SELECT avg(p_size) a1, stddev_pop(p_size) s1, avg(p_retailprice) a2, stddev_pop(p_retailprice) s2 FROM part)
SELECT p_brand, CAST(count(*) AS BIGINT) AS n,
       round(avg((p_size - a1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END), 6) AS mean_p_size,
       round(max((p_retailprice - a2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END), 6) AS max_p_retailprice
FROM part CROSS JOIN s GROUP BY p_brand""")
def q_standard_scale(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_retailprice")
    s = standard_scale(p, ["p_size", "p_retailprice"])
    return round_doubles(s.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"),
                                                   F.avg("p_size").alias("mean_p_size"),
                                                   F.max("p_retailprice").alias("max_p_retailprice")))


@query("minmax_scale", "F10", """
WITH s AS (SELECT min(p_size) a1, max(p_size) - min(p_size) r1, min(p_retailprice) a2,
                  max(p_retailprice) - min(p_retailprice) r2 FROM part)
SELECT p_brand, CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN r1 = 0 THEN 0.0 ELSE (p_size - a1) / r1 END), 6) AS mean_p_size,
       round(max(CASE WHEN r2 = 0 THEN 0.0 ELSE (p_retailprice - a2) / r2 END), 6) AS max_p_retailprice
FROM part CROSS JOIN s GROUP BY p_brand""")
def q_minmax_scale(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_retailprice")
    s = minmax_scale(p, ["p_size", "p_retailprice"])
    return round_doubles(s.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"),
                                                   F.avg("p_size").alias("mean_p_size"),
                                                   F.max("p_retailprice").alias("max_p_retailprice")))


@query("interactions", "F11 F12", """
SELECT l_returnflag, round(sum(l_quantity * l_discount), 6) AS l_quantity_x_l_discount,
       round(sum(l_extendedprice * l_extendedprice), 6) AS l_extendedprice_squared,
       round(sum(l_quantity * l_quantity), 6) AS l_quantity_squared
FROM lineitem GROUP BY l_returnflag""")
def q_interactions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_extendedprice")
    f = create_features(li, [("l_quantity", "l_discount"), ("l_quantity", "missing_col")],
                        ["l_extendedprice", "l_quantity"], date_parts=False)
    return round_doubles(f.groupBy("l_returnflag").agg(
        *[F.sum(c).alias(c) for c in ["l_quantity_x_l_discount", "l_extendedprice_squared", "l_quantity_squared"]]))


@query("date_parts", "F13", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_dayofweek,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(month(o_orderdate)) AS BIGINT) AS sum_month,
       CAST(sum(day(o_orderdate)) AS BIGINT) AS sum_day
FROM orders GROUP BY 1, 2""")
def q_date_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderdate")
    f = create_features(o)
    return f.groupBy("o_orderdate_year", "o_orderdate_dayofweek").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderdate_month").cast("bigint").alias("sum_month"),
        F.sum("o_orderdate_day").cast("bigint").alias("sum_day"))


# ----------------------------------------------------------------------------------------
# Splits and sampling

@query("hash_split", "D01", f"""
SELECT CASE WHEN {sql_hash('o_orderkey')} < 1500 THEN 'test' WHEN {sql_hash('o_orderkey')} < 3000 THEN 'val'
            ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1""")
def q_hash_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return hash_split(o, "o_orderkey", 0.15, 0.15).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("key_sum"))


_H32 = "('0x' || substr(md5(CAST({k} AS VARCHAR) || ':42'), 1, 8))::BIGINT"


@query("exact_split", "D01", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_H32.format(k='o_orderkey')}, CAST(o_orderkey AS VARCHAR)) AS rn,
                  count(*) OVER () AS n FROM orders),
c AS (SELECT o_orderkey, rn, CAST(ceil(n * 0.15) AS BIGINT) AS t1, n FROM r),
d AS (SELECT o_orderkey, rn, t1, t1 + CAST(ceil((n - t1) * (0.15 / (1 - 0.15))) AS BIGINT) AS t2 FROM c)
SELECT CASE WHEN rn <= t1 THEN 'test' WHEN rn <= t2 THEN 'val' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM d GROUP BY 1""")
def q_exact_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return hash_split(o, "o_orderkey", 0.15, 0.15, exact=True).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("key_sum"))


@query("stratified_split", "D03", f"""
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_H32.format(k='doc_id')}, CAST(doc_id AS VARCHAR)) AS rn,
                  count(*) OVER (PARTITION BY quality) AS n FROM labels),
c AS (SELECT doc_id, quality, rn, CAST(ceil(n * 0.2) AS BIGINT) AS t1, n FROM r),
d AS (SELECT doc_id, quality, rn, t1, t1 + CAST(ceil((n - t1) * (0.1 / (1 - 0.2))) AS BIGINT) AS t2 FROM c)
SELECT quality, CASE WHEN rn <= t1 THEN 'test' WHEN rn <= t2 THEN 'val' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(doc_id) AS BIGINT) AS key_sum
FROM d GROUP BY 1, 2""")
def q_stratified_split(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    s = hash_split(lab, "doc_id", 0.2, 0.1, exact=True, stratify_by="quality")
    return s.groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"),
                                             F.sum("doc_id").cast("bigint").alias("key_sum"))


@query("train_val_split", "D02", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_H32.format(k='o_orderkey')}, CAST(o_orderkey AS VARCHAR)) AS rn,
                  count(*) OVER () AS n FROM orders)
SELECT CASE WHEN rn <= CAST(floor(n * 0.2) AS BIGINT) THEN 'val' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM r GROUP BY 1""")
def q_train_val_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return train_val_split(o, "o_orderkey", 0.2, exact=True).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("key_sum"))


@query("shadow_sample", "D04", f"""
SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events
WHERE {sql_hash('event_id')} < 2500 GROUP BY event_type""")
def q_shadow_sample(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return sample_rate_filter(ev, "event_id", 0.25).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("dataset_shape", "D05 P02 P03", """
SELECT CAST(count(DISTINCT quality) AS BIGINT) AS num_classes, CAST(2 AS BIGINT) AS num_features FROM labels""")
def q_dataset_shape(spark, sf_dir):
    return dataset_shape(table(spark, sf_dir, "labels"), "quality")


# ----------------------------------------------------------------------------------------
# Whole pipelines: from a path to written splits (S13), fitted on the train rows only, and F14

_PART_SPLIT = _hash_case("o_orderkey", 1500, 3000)


@query("prepare_written", "F15 S13 S11 F09 F06", f"""
WITH b AS (SELECT *, {_PART_SPLIT} AS split FROM orders),
t AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s, avg(o_custkey) AS mc, stddev_pop(o_custkey) AS sc FROM b WHERE split = 'train')
SELECT split, CAST(count(*) AS BIGINT) AS n, round(max((o_totalprice - m) / s), 6) AS max_totalprice,
       round(min((o_custkey - mc) / sc), 6) AS min_custkey, CAST(sum(o_orderkey) AS BIGINT) AS keys,
       round(avg(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END), 6) AS mean_status
FROM b, t GROUP BY split""")
def q_prepare_written(spark, sf_dir):
    """orders: folder -> prepare, fitted on the train rows -> written splits -> read again; the saved
    preprocessor, loaded, gives the same rows as the one that was fitted."""
    import uuid

    from cadence.operators.prepare import Preprocessor, prepare_path
    from cadence.session import scratch_path
    base = scratch_path(spark, f"prepared/orders-{uuid.uuid4().hex[:8]}")
    raw = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    raw.write.parquet(f"{base}/raw")
    done = prepare_path(spark, f"{base}/raw", f"{base}/out", "o_orderkey", target="o_orderstatus", fit_on="train")
    again = Preprocessor.load(spark, done["preprocessor"]).transform(raw).select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")
    splits = spark.read.parquet(f"{base}/out/splits").select("o_orderkey", F.col("split").cast("string").alias("split"))
    return round_doubles(again.join(splits, "o_orderkey").groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.max("o_totalprice").alias("max_totalprice"),
        F.min("o_custkey").alias("min_custkey"), F.sum("o_orderkey").cast("bigint").alias("keys"),
        F.avg("o_orderstatus").alias("mean_status")))


@query("prepare_unseen", "F15 F01 F03 F06 F09 P07", f"""
WITH b AS (SELECT *, {_PART_SPLIT} AS split FROM orders),
g AS (SELECT o_orderkey, split, CASE WHEN split = 'train' OR o_orderkey % 3 > 0 THEN o_totalprice END AS price,
             CASE WHEN split = 'train' OR o_orderkey % 5 > 0 THEN o_custkey END AS cust,
             CASE WHEN split <> 'train' AND o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice + 1 END AS gauge,
             CASE WHEN split = 'train' OR o_orderkey % 4 > 0 THEN o_orderstatus END AS status FROM b),
t AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(cust) AS mc, stddev_pop(cust) AS sc, avg(gauge) AS mg, stddev_pop(gauge) AS sg,
             quantile_cont(gauge, 0.5) AS zg FROM g WHERE split = 'train'),
m AS (SELECT status AS ms FROM g WHERE split = 'train' GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS nulls, round(avg((coalesce(price, mp) - mp) / sp), 6) AS mean_price,
       round(avg((coalesce(cust, mc) - mc) / sc), 6) AS mean_cust, round(avg((coalesce(nullif(gauge, 0), zg) - mg) / sg), 6) AS mean_gauge,
       round(avg(CASE coalesce(status, ms) WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END), 6) AS mean_status
FROM g, t, m GROUP BY split""")
def q_prepare_unseen(spark, sf_dir):
    """Fitted on train rows that miss nothing; the other rows have NULLs in a number, an integer and a text, and
    zeros that stand for missing values. They get the fitted values."""
    raw = hash_split(table(spark, sf_dir, "orders"), "o_orderkey")
    train = F.col("split") == "train"
    key = F.col("o_orderkey")
    gaps = raw.select("o_orderkey", F.when(train | (key % 3 > 0), F.col("o_totalprice")).alias("price"),
                      F.when(train | (key % 5 > 0), F.col("o_custkey")).alias("cust"),
                      F.when(~train & (key % 7 == 0), 0.0).otherwise(F.col("o_totalprice") + 1).alias("gauge"),
                      F.when(train | (key % 4 > 0), F.col("o_orderstatus")).alias("status"))
    out, _, _ = prepare(gaps, "o_orderkey", "status", fit_on="train", zero_as_missing_columns=["gauge"])
    null = F.col("price").isNull() | F.col("cust").isNull() | F.col("gauge").isNull() | F.col("status").isNull()
    return round_doubles(out.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count_if(null).cast("bigint").alias("nulls"), F.avg("price").alias("mean_price"),
        F.avg("cust").alias("mean_cust"), F.avg("gauge").alias("mean_gauge"), F.avg("status").alias("mean_status")))


@query("run_pipeline", "F14 F01 F05 F08", """
WITH c AS (SELECT c_acctbal, CAST(c_nationkey AS DOUBLE) AS n, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS seg FROM customer)
SELECT CAST(count(*) AS BIGINT) AS n, round(max((c_acctbal - a) / s), 6) AS max_acctbal, round(min((n - an) / sn), 6) AS min_nation,
       round(max((seg - ag) / sg), 6) AS max_segment
FROM c, (SELECT avg(c_acctbal) AS a, stddev_pop(c_acctbal) AS s, avg(n) AS an, stddev_pop(n) AS sn, avg(seg) AS ag, stddev_pop(seg) AS sg FROM c)""")
def q_run_pipeline(spark, sf_dir):
    from cadence.operators.prepare import run_pipeline
    out = run_pipeline(table(spark, sf_dir, "customer").select("c_acctbal", "c_nationkey", "c_mktsegment"))
    return round_doubles(out.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.max("c_acctbal").alias("max_acctbal"),
                                 F.min("c_nationkey").alias("min_nation"), F.max("c_mktsegment").alias("max_segment")))
