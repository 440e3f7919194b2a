"""Validation and profiling queries (V01-V16) over events, lineitem and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.columns import round_doubles
from cadence.operators.validate import (DataSchema, column_profile, duplicate_ratio, findings,
                                        null_profile, numeric_summary, top_values, validate,
                                        validate_splits)
from cadence.plans.catalog import query
from cadence.tables import table


def profiled_events(spark, sf_dir):
    """events with missing values where the data says so: low values and error payloads."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("props"),
        F.year("ts").alias("year"))


_EV_SQL = """
ev AS (SELECT event_id, ts, user_id, event_type,
              CASE WHEN value >= 10 THEN value END AS value,
              CASE WHEN event_type <> 'error' THEN props END AS props,
              CAST(year(ts) AS INTEGER) AS year
       FROM events)"""

_NULL_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "year"]


def _null_sql():
    parts = [f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
             f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_ratio FROM ev"
             for c in _NULL_COLS]
    return (f"WITH {_EV_SQL}, p AS ({' UNION ALL '.join(parts)}) "
            "SELECT \"column\", null_count, null_ratio, CASE WHEN null_ratio > 0.15 THEN 'error' "
            "WHEN null_ratio > 0.1 THEN 'warning' ELSE 'ok' END AS severity FROM p")


@query("null_profile", "V02 P01", _null_sql())
def q_null_profile(spark, sf_dir):
    return round_doubles(null_profile(profiled_events(spark, sf_dir), max_null_ratio=0.15))


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


def _numeric_sql():
    parts = [f"""SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem"""
             for c in _LI_NUM]
    return " UNION ALL ".join(parts)


@query("numeric_summary", "V09", _numeric_sql())
def q_numeric_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return round_doubles(numeric_summary(li, _LI_NUM))


@query("duplicate_ratio", "V04", """
SELECT CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem)) AS BIGINT) AS duplicates,
       round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem))) / count(*), 6) AS duplicate_ratio
FROM lineitem""")
def q_duplicate_ratio(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return round_doubles(duplicate_ratio(li))


_CONST_COLS = ["l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate"]


def _const_sql():
    parts = [f"""SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count,
       (count({c}) > 0 AND min({c}) = max({c})) AS is_constant
       FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'N'""" for c in _CONST_COLS]
    return " UNION ALL ".join(parts)


@query("constant_columns", "V05 V07", _const_sql())
def q_constant_columns(spark, sf_dir):
    li = (table(spark, sf_dir, "lineitem").where((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"))
          .select(*_CONST_COLS))
    prof = column_profile(li)
    rows = [(c, s["missing"], bool(s["constant"])) for c, s in prof["columns"].items()]
    return spark.createDataFrame(rows, "column string, null_count bigint, is_constant boolean")


_TOP_COLS = ["o_orderstatus", "o_orderpriority"]


def _top_sql():
    parts = [f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS count "
             f"FROM orders WHERE {c} IS NOT NULL GROUP BY {c}" for c in _TOP_COLS]
    return f"""WITH c AS ({' UNION ALL '.join(parts)}),
u AS (SELECT "column", CAST(count(*) AS BIGINT) AS unique_values FROM c GROUP BY "column"),
r AS (SELECT "column", value, count,
             CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC) AS INTEGER) AS rank FROM c)
SELECT r."column", r.value, r.count, r.rank, u.unique_values FROM r JOIN u USING ("column") WHERE rank <= 3"""


@query("top_values", "V10 V11", _top_sql())
def q_top_values(spark, sf_dir):
    return top_values(table(spark, sf_dir, "orders"), _TOP_COLS, k=3)


EVENT_SCHEMA = DataSchema(required_columns=["event_id", "ts", "user_id", "session_id"],
                          numeric_columns=["value", "event_type", "year"],
                          target_column="label", min_rows=100, max_null_ratio=0.3)

_FINDINGS_SQL = f"""
WITH {_EV_SQL},
n AS (SELECT count(*) AS n FROM ev),
nulls AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) / count(*) AS r FROM ev" for c in _NULL_COLS)}),
f AS (
  SELECT 'schema' AS "check", 'session_id' AS column, 'error' AS severity, 1.0::DOUBLE AS value,
         NULL::DOUBLE AS threshold, 'Missing required columns: {{''session_id''}}' AS message
  UNION ALL SELECT 'schema', 'event_type', 'error', NULL, NULL, 'Column event_type should be numeric but is string'
  UNION ALL SELECT 'schema', 'label', 'error', NULL, NULL, 'Target column ''label'' not found'
  UNION ALL SELECT 'null_ratio', col, CASE WHEN r > 0.3 THEN 'error' ELSE 'warning' END, round(r, 6),
         CASE WHEN r > 0.3 THEN 0.3 ELSE 0.1 END,
         CASE WHEN r > 0.3 THEN 'Column ''' || col || ''' has ' || printf('%.1f', r * 100) || '% null values (max: 30.0%)'
              ELSE 'Column ''' || col || ''' has ' || printf('%.1f', r * 100) || '% null values' END
    FROM nulls WHERE r > 0.1
  UNION ALL SELECT 'min_rows', NULL, 'error', n, 100.0, 'Insufficient data: ' || n || ' rows (minimum: 100)'
    FROM n WHERE n < 100
  UNION ALL SELECT 'constant', 'year', 'warning', NULL, NULL, 'Column ''year'' has constant value'
    FROM ev HAVING count(year) > 0 AND min(year) = max(year)
  UNION ALL SELECT 'zero_variance', 'year', 'warning', 0.0, 0.0, 'Column ''year'' has zero variance'
    FROM ev HAVING stddev_samp(year) = 0)
SELECT * FROM f"""


@query("validation_findings", "V01 V02 V03 V04 V05 V06 V12 J05", _FINDINGS_SQL)
def q_validation_findings(spark, sf_dir):
    f, _ = findings(profiled_events(spark, sf_dir), EVENT_SCHEMA)
    return round_doubles(f)


@query("validation_summary", "V12 V14", f"""
WITH {_EV_SQL},
nulls AS ({' UNION ALL '.join(f"SELECT count(*) FILTER (WHERE {c} IS NULL) / count(*) AS r FROM ev" for c in _NULL_COLS)}),
w AS (SELECT CAST(count(*) FILTER (WHERE r > 0.1 AND r <= 0.3) AS BIGINT) + 2 AS n_warnings,
             CAST(count(*) FILTER (WHERE r > 0.3) AS BIGINT) + 3 AS n_errors FROM nulls)
SELECT n_errors = 0 AS is_valid, (SELECT CAST(count(*) AS BIGINT) FROM ev) AS num_samples,
       CAST(7 AS BIGINT) AS num_features, n_errors, n_warnings,
       round(1.0 - (n_errors + n_warnings) / {3 + 2 * 7 + 3 + 1}.0, 6) AS quality_score
FROM w""")
def q_validation_summary(spark, sf_dir):
    _, s = validate(profiled_events(spark, sf_dir), EVENT_SCHEMA)
    return round_doubles(s)


@query("split_validation", "V15 D01", """
WITH s AS (
  SELECT l_orderkey,
         CASE WHEN (('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || ':42'), 1, 8))::BIGINT % 10000) < 1500 THEN 'test'
              WHEN (('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || ':42'), 1, 8))::BIGINT % 10000) < 3000 THEN 'val'
              ELSE 'train' END AS split
  FROM lineitem)
SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS rows_with_nulls,
       CAST((SELECT count(*) FROM (SELECT l_orderkey FROM s GROUP BY l_orderkey HAVING count(DISTINCT split) > 1)) AS BIGINT) AS shared_keys,
       true AS valid
FROM s GROUP BY split""")
def q_split_validation(spark, sf_dir):
    from cadence.plans.preparation import prepared_lineitem
    out, _ = prepared_lineitem(spark, sf_dir)
    return validate_splits(out.drop("l_linenumber"), "l_orderkey")
