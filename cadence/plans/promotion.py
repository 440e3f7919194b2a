"""Registry and promotion queries (R01-R16) over orders and events.

Model versions from orders: model = o_orderpriority, version = rank of o_orderkey within the
model, stage by o_orderstatus (F Production, O Staging, P None), metric values from key
arithmetic: accuracy = (o_orderkey*37 % 1000)/1000, f1 = (o_custkey*13 % 1000)/1000,
precision = (o_orderkey*11 % 1000)/1000, recall = (o_custkey*7 % 1000)/1000.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.functions.columns import round_doubles
from cadence.operators.registry import (champion_challenger, compare_versions, find_run,
                                        get_or_create_experiments, latest_metrics,
                                        latest_versions, params_as_strings, promotion_decisions,
                                        register_versions, resolve_model, run_status,
                                        threshold_gate, transition_stage)
from cadence.plans.catalog import query
from cadence.tables import table


def model_versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_orderpriority").orderBy("o_orderkey")

    def m(c, k):
        return ((F.col(c) * k) % 1000) / F.lit(1000.0)
    return o.select(
        F.col("o_orderpriority").alias("model_name"), F.row_number().over(w).cast("long").alias("version"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging")
         .otherwise("None").alias("stage"),
        m("o_orderkey", 37).alias("accuracy"), m("o_custkey", 13).alias("f1_score"),
        m("o_orderkey", 11).alias("precision"), m("o_custkey", 7).alias("recall"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))


_MV = """mv AS (SELECT o_orderpriority AS model_name,
                CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS BIGINT) AS version,
                'run_' || CAST(o_orderkey AS VARCHAR) AS run_id,
                CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'None' END AS stage,
                (o_orderkey * 37 % 1000) / 1000.0::DOUBLE AS accuracy, (o_custkey * 13 % 1000) / 1000.0::DOUBLE AS f1_score,
                (o_orderkey * 11 % 1000) / 1000.0::DOUBLE AS precision, (o_custkey * 7 % 1000) / 1000.0::DOUBLE AS recall,
                o_orderdate AS created_at FROM orders)"""


@query("latest_versions", "R08", f"""WITH {_MV}
SELECT model_name, stage, max(version) AS version, arg_max(run_id, version) AS run_id FROM mv GROUP BY 1, 2""")
def q_latest_versions(spark, sf_dir):
    return latest_versions(model_versions(spark, sf_dir))


@query("resolve_model", "R09", f"""WITH {_MV},
req AS (SELECT DISTINCT model_name, 7::BIGINT AS version, NULL::VARCHAR AS stage FROM mv
        UNION ALL SELECT DISTINCT model_name, NULL, 'Staging' FROM mv
        UNION ALL SELECT DISTINCT model_name, NULL, NULL FROM mv),
ls AS (SELECT model_name, stage, max(version) AS vs FROM mv GROUP BY 1, 2),
la AS (SELECT model_name, max(version) AS va FROM mv GROUP BY 1)
SELECT r.model_name, r.version AS requested_version, r.stage,
       CAST(CASE WHEN r.version IS NOT NULL THEN (SELECT max(version) FROM mv WHERE mv.model_name = r.model_name AND mv.version = r.version)
                 WHEN r.stage IS NOT NULL THEN ls.vs ELSE la.va END AS BIGINT) AS resolved_version,
       CASE WHEN r.version IS NOT NULL THEN 'version' WHEN r.stage IS NOT NULL THEN 'stage' ELSE 'latest' END AS source
FROM req r LEFT JOIN ls ON r.model_name = ls.model_name AND r.stage = ls.stage LEFT JOIN la ON r.model_name = la.model_name""")
def q_resolve_model(spark, sf_dir):
    mv = model_versions(spark, sf_dir)
    models = mv.select("model_name").distinct()
    req = (models.select("model_name", F.lit(7).cast("long").alias("version"), F.lit(None).cast("string").alias("stage"))
           .unionByName(models.select("model_name", F.lit(None).cast("long").alias("version"), F.lit("Staging").alias("stage")))
           .unionByName(models.select("model_name", F.lit(None).cast("long").alias("version"), F.lit(None).cast("string").alias("stage"))))
    return resolve_model(mv, req)


def _metrics_long(mv):
    return mv.select("model_name", "version", F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in ("accuracy", "f1_score", "precision", "recall")
    ])).alias("m")).select("model_name", "version", "m.metric", "m.value")


@query("compare_versions", "R10 J02", f"""WITH {_MV},
ml AS (SELECT model_name, version, 'accuracy' AS metric, accuracy AS value FROM mv
       UNION ALL SELECT model_name, version, 'f1_score', f1_score FROM mv
       UNION ALL SELECT model_name, version, 'precision', precision FROM mv
       UNION ALL SELECT model_name, version, 'recall', recall FROM mv),
a AS (SELECT model_name, metric, value AS a FROM ml WHERE version = 1),
b AS (SELECT model_name, metric, value AS b FROM ml WHERE version = 2)
SELECT model_name, metric, round(a, 6) AS a, round(b, 6) AS b, round(b - a, 6) AS diff, b > a AS improvement
FROM a JOIN b USING (model_name, metric) WHERE a IS NOT NULL AND b IS NOT NULL""")
def q_compare_versions(spark, sf_dir):
    return round_doubles(compare_versions(_metrics_long(model_versions(spark, sf_dir)), 1, 2))


_GATE_SQL = """concat_ws('; ', CASE WHEN accuracy < 0.85 THEN 'Accuracy ' || printf('%.3f', accuracy) || ' < 0.85' END,
                     CASE WHEN f1_score < 0.8 THEN 'F1 Score ' || printf('%.3f', f1_score) || ' < 0.8' END,
                     CASE WHEN precision < 0.75 THEN 'Precision ' || printf('%.3f', precision) || ' < 0.75' END,
                     CASE WHEN recall < 0.75 THEN 'Recall ' || printf('%.3f', recall) || ' < 0.75' END)"""


@query("threshold_gate", "R11", f"""WITH {_MV}, g AS (SELECT model_name, version, {_GATE_SQL} AS r FROM mv)
SELECT model_name, version, r = '' AS passes, CASE WHEN r = '' THEN 'All thresholds met' ELSE r END AS reason FROM g""")
def q_threshold_gate(spark, sf_dir):
    return threshold_gate(model_versions(spark, sf_dir)).select("model_name", "version", "passes", "reason")


_CC = f"""{_MV},
cand AS (SELECT model_name, version, accuracy, f1_score, precision, recall FROM
         (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS rn FROM mv WHERE stage = 'None') WHERE rn = 1),
champ AS (SELECT model_name, version AS champion_version, accuracy AS final_accuracy FROM
          (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS rn FROM mv WHERE stage = 'Production') WHERE rn = 1),
j AS (SELECT c.*, h.champion_version, h.final_accuracy AS champion_value, c.accuracy - h.final_accuracy AS imp
      FROM cand c LEFT JOIN champ h USING (model_name)),
d AS (SELECT *, CASE WHEN champion_version IS NULL THEN true WHEN accuracy IS NULL OR champion_value IS NULL THEN false
                     ELSE imp >= 0.01 END AS is_better FROM j)"""


def _candidates(spark, sf_dir):
    mv = model_versions(spark, sf_dir)
    w = Window.partitionBy("model_name").orderBy(F.col("version").desc())
    cand = (mv.where(F.col("stage") == "None").withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("model_name", "version", "accuracy", "f1_score", "precision", "recall"))
    prod = latest_versions(mv, "Production").select("model_name", F.col("version").alias("champion_version"))
    champ = prod.join(mv.select("model_name", F.col("version").alias("champion_version"),
                                F.col("accuracy").alias("final_accuracy")), ["model_name", "champion_version"])
    return cand, champ


@query("champion_challenger", "R12 J07 J03", f"""WITH {_CC}
SELECT model_name, version, champion_version, round(imp, 6) AS improvement, is_better FROM d""")
def q_champion_challenger(spark, sf_dir):
    cand, champ = _candidates(spark, sf_dir)
    out = champion_challenger(cand, champ)
    return round_doubles(out.select("model_name", "version", "champion_version", "improvement", "is_better"))


@query("promotion", "R15", f"""WITH {_CC},
g AS (SELECT *, {_GATE_SQL} = '' AS passes FROM d)
SELECT model_name, version, passes, is_better,
       CASE WHEN passes AND is_better THEN 'Production' WHEN passes THEN 'Staging' END AS new_stage,
       CASE WHEN passes AND is_better THEN champion_version END AS previous_production_version FROM g""")
def q_promotion(spark, sf_dir):
    cand, champ = _candidates(spark, sf_dir)
    d = promotion_decisions(cand, champ, "auto")
    return d.select("model_name", "version", "passes", "is_better", "new_stage", "previous_production_version")


@query("register_versions", "R05", f"""WITH {_MV},
cur AS (SELECT model_name, max(version) AS mx FROM mv WHERE stage <> 'None' GROUP BY 1),
nw AS (SELECT * FROM mv WHERE stage = 'None')
SELECT n.model_name, CAST(COALESCE(c.mx, 0) + row_number() OVER (PARTITION BY n.model_name ORDER BY n.created_at, n.run_id) AS BIGINT) AS version,
       n.run_id, 'None' AS stage,
       'accuracy: ' || printf('%.4f', n.accuracy) || chr(10) || 'f1_score: ' || printf('%.4f', n.f1_score) AS description
FROM nw n LEFT JOIN cur c USING (model_name)""")
def q_register_versions(spark, sf_dir):
    mv = model_versions(spark, sf_dir)
    existing = mv.where(F.col("stage") != "None")
    new = mv.where(F.col("stage") == "None").drop("version", "stage")
    return register_versions(existing, new, ["accuracy", "f1_score"]).drop("created_at")


@query("stage_transition", "R06", f"""WITH {_MV},
t AS (SELECT model_name, version AS tv FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY accuracy DESC, version) AS rn
                                          FROM mv WHERE stage = 'Staging') WHERE rn = 1),
n AS (SELECT mv.model_name, CASE WHEN mv.version = t.tv THEN 'Production' WHEN mv.stage = 'Production' THEN 'Archived' ELSE mv.stage END AS stage
      FROM mv LEFT JOIN t USING (model_name))
SELECT model_name, stage, CAST(count(*) AS BIGINT) AS n FROM n GROUP BY 1, 2""")
def q_stage_transition(spark, sf_dir):
    mv = model_versions(spark, sf_dir)
    w = Window.partitionBy("model_name").orderBy(F.col("accuracy").desc(), F.col("version"))
    targets = (mv.where(F.col("stage") == "Staging").withColumn("rn", F.row_number().over(w)).where("rn = 1")
               .select("model_name", "version", F.lit("Production").alias("stage")))
    out = transition_stage(mv, targets)
    return out.groupBy("model_name", "stage").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# ----------------------------------------------------------------------------------------
# Run tracking from events: run = user, metric = event_type, step = event_id

def run_metrics(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
                     F.col("event_type").alias("metric"), F.col("event_id").alias("step"), "value", "ts")


@query("run_latest_metrics", "R03", """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, event_type AS metric, round(arg_max(value, event_id), 6) AS value,
       max(event_id) AS step FROM events GROUP BY 1, 2""")
def q_run_latest_metrics(spark, sf_dir):
    return round_doubles(latest_metrics(run_metrics(spark, sf_dir)))


@query("run_status", "R02", """
WITH r AS (SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, ts,
                  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'FINISHED' ELSE 'RUNNING' END AS status FROM events)
SELECT run_id, arg_max(status, (ts, status)) AS status, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at FROM r GROUP BY 1""")
def q_run_status(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    r = ev.select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"), "ts",
                  F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "FINISHED")
                   .otherwise("RUNNING").alias("status"))
    s = run_status(r)
    return s.select("run_id", "status", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started_at"))


@query("find_run", "R07", """
SELECT run_name, CAST(arg_max(event_id, (ts, event_id)) AS VARCHAR) AS run_id FROM
  (SELECT event_type AS run_name, event_id, ts FROM events) GROUP BY 1""")
def q_find_run(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    runs = ev.select(F.col("event_type").alias("run_name"), F.col("event_id").cast("string").alias("run_id"),
                     F.col("ts").alias("started_at"), F.col("event_id"))
    w = find_run(runs.withColumn("run_id", F.col("event_id")))
    return w.select("run_name", F.col("run_id").cast("string").alias("run_id"))


@query("experiments", "R01", """
WITH ex AS (SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment <> 'MACHINERY'),
e AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS experiment_id FROM ex),
req AS (SELECT DISTINCT c_mktsegment AS name FROM customer UNION SELECT r_name FROM region),
mx AS (SELECT max(experiment_id) AS m FROM e)
SELECT r.name, e.experiment_id, false AS created FROM req r JOIN e USING (name)
UNION ALL
SELECT r.name, CAST(mx.m + row_number() OVER (ORDER BY r.name) AS BIGINT), true FROM req r CROSS JOIN mx
WHERE r.name NOT IN (SELECT name FROM e)""")
def q_experiments(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    ex = c.select(F.col("c_mktsegment").alias("name")).where(F.col("name") != "MACHINERY").distinct()
    existing = ex.withColumn("experiment_id", F.row_number().over(Window.orderBy("name")).cast("long"))
    req = c.select(F.col("c_mktsegment").alias("name")).unionByName(
        table(spark, sf_dir, "region").select(F.col("r_name").alias("name")))
    return get_or_create_experiments(existing, req).select("name", "experiment_id", "created")


@query("promotion_staging", "R13", f"""WITH {_CC}, g AS (SELECT *, {_GATE_SQL} = '' AS passes FROM d)
SELECT model_name, version, CASE WHEN passes THEN 'Staging' END AS new_stage, passes AS promoted FROM g""")
def q_promotion_staging(spark, sf_dir):
    d = promotion_decisions(*_candidates(spark, sf_dir), target="Staging")
    return d.select("model_name", "version", "new_stage", "promoted")


@query("promotion_production", "R14", f"""WITH {_CC}
SELECT model_name, version, CASE WHEN is_better THEN 'Production' END AS new_stage, is_better AS promoted,
       CASE WHEN is_better THEN champion_version END AS previous_production_version FROM d""")
def q_promotion_production(spark, sf_dir):
    d = promotion_decisions(*_candidates(spark, sf_dir), target="Production")
    return d.select("model_name", "version", "new_stage", "promoted", "previous_production_version")


@query("stage_transition_many", "R06", f"""WITH {_MV},
n AS (SELECT model_name, CASE WHEN version = 1 THEN 'Production' WHEN version = 2 THEN 'Staging'
                              WHEN stage IN ('Production', 'Staging') THEN 'Archived' ELSE stage END AS stage FROM mv)
SELECT model_name, stage, CAST(count(*) AS BIGINT) AS n FROM n GROUP BY 1, 2""")
def q_stage_transition_many(spark, sf_dir):
    """Two targets for every model at once: version 1 to Production, version 2 to Staging."""
    mv = model_versions(spark, sf_dir)
    models = mv.select("model_name").distinct()
    targets = models.select("model_name", F.lit(1).cast("long").alias("version"), F.lit("Production").alias("stage")).unionByName(
        models.select("model_name", F.lit(2).cast("long").alias("version"), F.lit("Staging").alias("stage")))
    return transition_stage(mv, targets).groupBy("model_name", "stage").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("compare_lower_is_better", "R10", f"""WITH {_MV},
a AS (SELECT model_name, recall AS a FROM mv WHERE version = 1), b AS (SELECT model_name, recall AS b FROM mv WHERE version = 2)
SELECT model_name, 'recall' AS metric, round(b - a, 6) AS diff, b < a AS improvement FROM a JOIN b USING (model_name)""")
def q_compare_lower_is_better(spark, sf_dir):
    """recall read as a loss."""
    long = _metrics_long(model_versions(spark, sf_dir)).where(F.col("metric") == "recall")
    out = compare_versions(long, 1, 2, lower_is_better=("recall",))
    return round_doubles(out.select("model_name", "metric", "diff", "improvement"))


@query("run_params", "R04", """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, 'events' AS param, CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY 1, 2""")
def q_run_params(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return params_as_strings(ev.groupBy(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"))
                             .agg(F.lit("events").alias("param"), F.count(F.lit(1)).alias("value")).select("run_id", "param", "value"))
