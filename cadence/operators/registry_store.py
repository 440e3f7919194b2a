"""Persistent registry tables (R01-R06, R16) as append-only Parquet datasets.

Every write is an append: experiments, run events (start / end with status), metrics,
params, model versions and stage events. "Current" views are aggregates over the events
(``max_by`` on time), so a stage transition never rewrites a table in place and a retried job
at worst appends rows that the views de-duplicate by key and time. Experiment ids and model
versions are claims: a writer appends one, reads back who claimed it first (time, then run or
name), and claims the next number if another did; views show the first claim of a number.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.registry import metrics_description

SCHEMAS = {
    "experiments": "experiment_id bigint, name string, artifact_location string, created_at timestamp",
    "run_events": "run_id string, experiment_id bigint, run_name string, status string, ts timestamp, error string",
    "run_metrics": "run_id string, metric string, step bigint, value double, ts timestamp",
    "run_params": "run_id string, param string, value string, ts timestamp",
    "model_versions": "model_name string, version bigint, run_id string, description string, created_at timestamp",
    "stage_events": "model_name string, version bigint, stage string, ts timestamp",
}


class RegistryStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """The table, empty where nothing was written yet; Spark looks, whatever the store."""
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def append(self, name: str, df: DataFrame) -> None:
        cols = [c.strip().split(" ")[0] for c in SCHEMAS[name].split(",")]
        df.select(*cols).write.mode("append").parquet(self.path(name))

    def _now(self):
        return F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")

    # R01
    def experiment(self, name: str) -> int:
        hit = self.experiments().where(F.col("name") == name).select("experiment_id").limit(1).collect()
        if hit:
            return hit[0][0]
        new_id = (self.read("experiments").agg(F.max("experiment_id")).first()[0] or 0) + 1
        row = self.spark.range(1).select(F.lit(new_id).cast("bigint").alias("experiment_id"), F.lit(name).alias("name"),
                                         F.lit(f"{self.root}/artifacts/{new_id}").alias("artifact_location"),
                                         self._now().alias("created_at"))
        self.append("experiments", row)
        first = self.experiments().where(F.col("experiment_id") == new_id).first()["name"]
        return new_id if first == name else self.experiment(name)

    def experiments(self) -> DataFrame:
        """Experiments, every id with the first name that claimed it."""
        return self.read("experiments").groupBy("experiment_id").agg(
            F.min_by(F.struct("name", "artifact_location", "created_at"), F.struct("created_at", "name")).alias("e")) \
            .select("experiment_id", "e.*")

    # R02
    def run_event(self, run_id: str, experiment_id: int, run_name: str, status: str, error: str | None = None) -> None:
        row = self.spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(experiment_id).cast("bigint").alias("experiment_id"),
                                         F.lit(run_name).alias("run_name"), F.lit(status).alias("status"),
                                         self._now().alias("ts"), F.lit(error).cast("string").alias("error"))
        self.append("run_events", row)

    def runs(self) -> DataFrame:
        """Latest status per run, with start and end time."""
        ev = self.read("run_events")
        return ev.groupBy("run_id").agg(
            F.max_by("status", F.struct("ts", "status")).alias("status"),
            F.max_by("run_name", "ts").alias("run_name"), F.max_by("experiment_id", "ts").alias("experiment_id"),
            F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"))

    # R03 / R04 / R16
    def log_metrics(self, run_id: str, metrics: dict[str, float], step: int = 0) -> None:
        rows = [(run_id, k, step, float(v)) for k, v in metrics.items() if v is not None]
        df = self.spark.createDataFrame(rows, "run_id string, metric string, step bigint, value double")
        self.append("run_metrics", df.withColumn("ts", self._now()))

    def log_params(self, run_id: str, params: dict) -> None:
        rows = [(run_id, k, str(v)) for k, v in params.items()]
        df = self.spark.createDataFrame(rows, "run_id string, param string, value string")
        self.append("run_params", df.withColumn("ts", self._now()))

    def latest_metrics(self) -> DataFrame:
        m = self.read("run_metrics")
        return m.groupBy("run_id", "metric").agg(F.max_by("value", F.struct("step", "ts")).alias("value"))

    # R05
    def register(self, model_name: str, run_id: str, metrics: dict[str, float] | None = None) -> int:
        cur = self.read("model_versions").where(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
        version = (cur or 0) + 1
        m = {k: v for k, v in (metrics or {}).items() if v is not None}
        row = self.spark.createDataFrame([tuple(m.values())], ", ".join(f"`{k}` double" for k in m)) if m else \
            self.spark.range(1)
        row = row.select(F.lit(model_name).alias("model_name"), F.lit(version).cast("bigint").alias("version"),
                         F.lit(run_id).alias("run_id"),
                         (metrics_description(cols=list(m)) if m else F.lit(None).cast("string")).alias("description"),
                         self._now().alias("created_at"))
        self.append("model_versions", row)
        if self._claims().where((F.col("model_name") == model_name) & (F.col("version") == version)).first()["run_id"] != run_id:
            return self.register(model_name, run_id, metrics)
        self.append("stage_events", row.select("model_name", "version", F.lit("None").alias("stage"),
                                                F.col("created_at").alias("ts")))
        return version

    # R06
    def transition(self, model_name: str, version: int, stage: str, archive_existing: bool = True) -> None:
        """Append a stage event for the version and, when asked, 'Archived' events for the
        versions currently in that stage."""
        now = self._now()
        events = self.spark.range(1).select(F.lit(model_name).alias("model_name"),
                                            F.lit(version).cast("bigint").alias("version"),
                                            F.lit(stage).alias("stage"), now.alias("ts"))
        if archive_existing:
            others = (self.versions().where((F.col("model_name") == model_name) & (F.col("stage") == stage)
                                            & (F.col("version") != version))
                      .select("model_name", "version", F.lit("Archived").alias("stage"), now.alias("ts")))
            events = events.unionByName(others)
        self.append("stage_events", events)

    def versions(self) -> DataFrame:
        """Model versions with their current stage (latest stage event)."""
        st = self.read("stage_events").groupBy("model_name", "version").agg(
            F.max_by("stage", F.struct("ts", "stage")).alias("stage"))
        return self._claims().join(st, ["model_name", "version"], "left")

    def _claims(self) -> DataFrame:
        """Model versions, every number with the run that claimed it first."""
        return self.read("model_versions").groupBy("model_name", "version").agg(
            F.min_by(F.struct("run_id", "description", "created_at"), F.struct("created_at", "run_id")).alias("v")) \
            .select("model_name", "version", "v.*")
