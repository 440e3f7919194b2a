"""Structured Streaming operators.

Sources are file streams with an explicit schema; sinks are Parquet (append) or
``foreachBatch`` (update); checkpoints and outputs live under the shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted driver or lost executor resumes exactly-once.
Event time must be a TIMESTAMP (the driver tables store timestamp_ntz), so streams cast it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from cadence.functions.hashing import hash_bucket
from cadence.operators.monitor import histogram_counts, histogram_rows
from cadence.session import scratch_path


def file_stream(spark: SparkSession, directory: str, file_glob: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over ``directory`` limited to files matching ``file_glob``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream: one Parquet file, or a folder of that name with the files of the table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A file stream reads a folder, and a glob filter sees file names only.
    df = file_stream(spark, path, "*", schema) if _is_folder(spark, path) else file_stream(spark, sf_dir, f"{name}.parquet", schema)
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(p).isDirectory()


def run_available(df: DataFrame, name: str, output_mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a streaming plan over everything available now (trigger availableNow) into a
    Parquet sink; returns the written table. With the same ``base`` folder a later run resumes
    from its checkpoint and appends what is new, exactly once; without one, a new folder
    under the shared checkpoint folder is used."""
    spark = df.sparkSession
    base = base or scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:8]}")
    _run(df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/data"))
    return spark.read.parquet(f"{base}/data")


def run_updates(df: DataFrame, name: str, keys: list[str], base: str | None = None) -> DataFrame:
    """Run a streaming aggregate in update mode and return the last row of every key, open
    windows included. Every micro-batch writes the rows it changed as ``epoch=<batch id>``
    (a retried batch replaces its own); a later run with the same ``base`` resumes."""
    spark = df.sparkSession
    base = base or scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:8]}")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/data/epoch={epoch}")

    _run(df.writeStream.outputMode("update").option("checkpointLocation", f"{base}/_checkpoint").foreachBatch(write))
    rows = spark.read.parquet(f"{base}/data")
    values = [c for c in df.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("__v")).select(*keys, "__v.*")


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# W01 ----------------------------------------------------------------------------------

def canary_windows(log: DataFrame, percentage: float, window: str = "30 minutes",
                   watermark: str = "30 minutes", key: str = "user_id", approx_accuracy: int = 10000,
                   group: list[str] | None = None) -> DataFrame:
    """Canary metrics per tumbling window and arm (and ``group``). Late rows beyond the
    watermark are dropped; in append mode a window is emitted once the watermark passes its
    end, in update mode (``run_updates``) whenever it changes, open windows included. The
    percentiles have a rank error of at most 1 / ``approx_accuracy``."""
    g = group or []
    arm = F.when(hash_bucket(F.col(key), 100) < F.lit(percentage), "canary").otherwise("production")
    return (log.withWatermark("ts", watermark).withColumn("arm", arm)
            .groupBy(F.window("ts", window).alias("w"), "arm", *g)
            .agg(F.count(F.lit(1)).cast("bigint").alias("requests"),
                 F.count_if(F.col("is_error")).cast("bigint").alias("errors"),
                 F.percentile_approx("latency_ms", [0.5, 0.95, 0.99], approx_accuracy).alias("latency_pct"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "arm", *g,
                    "requests", "errors", "latency_pct"))


# W02 ----------------------------------------------------------------------------------

def stream_scores(stream: DataFrame, scorer, version: str) -> DataFrame:
    """Score a stream with a batch-fitted scorer (a function DataFrame -> DataFrame or a
    Spark ML model) and tag the model version."""
    out = scorer.transform(stream) if hasattr(scorer, "transform") else scorer(stream)
    return out.withColumn("model_version", F.lit(version))


# W03 ----------------------------------------------------------------------------------

def pair_streams(production: DataFrame, shadow: DataFrame, max_delay: str = "10 minutes",
                 watermark: str = "10 minutes", key: str = "request_id") -> DataFrame:
    """Stream-stream inner join of production and shadow predictions of one request, the
    shadow row arriving within ``max_delay`` after production. Both sides carry watermarks,
    so join state is bounded and rows later than the watermark are dropped."""
    p = production.withWatermark("ts", watermark)
    s = shadow.withColumnRenamed(key, "__sk").withColumnRenamed("ts", "__sts").withWatermark("__sts", watermark)
    cond = F.expr(f"{key} = __sk AND __sts >= ts AND __sts <= ts + INTERVAL {max_delay}")
    return p.join(s, cond, "inner").drop("__sk")


# W04 ----------------------------------------------------------------------------------

ROLLOUT_STATE_SCHEMA = "stage_index int, status string, stages_completed array<int>, last_window timestamp"
ROLLOUT_OUTPUT_SCHEMA = ("deployment_id string, window_start timestamp, stage_index int, percentage int, "
                         "healthy boolean, status string, stages_completed array<int>")


def rollout_state_machine(stage_metrics: DataFrame, stages: list[int], error_rate_threshold: float,
                          latency_threshold_ms: float, health_threshold: float) -> DataFrame:
    """Per deployment, consume window metrics (deployment_id, window_start, requests,
    errors, latency_p95_ms) in event-time order and advance the canary: healthy -> next
    stage (completed after 100 %), unhealthy -> rolled_back (terminal). A micro-batch's windows
    of a deployment are ordered together, however Arrow cut them; a window not newer than the
    last one consumed is ignored. One row per window of a deployment at most."""

    def step(key, batches: Iterator[pd.DataFrame], state):
        if state.exists:
            idx, status, done, last = state.get
            done = list(done)
        else:
            idx, status, done, last = 0, "in_progress", [], None
        windows = pd.concat(list(batches)).sort_values("window_start")
        if last is not None:
            windows = windows[windows["window_start"] > pd.Timestamp(last)]
        # Health of all windows at once; the walk below is as long as the list of stages.
        errors = (windows["errors"] / windows["requests"]).where(windows["requests"] > 0, 0.0)
        health = (1.0 - errors).where(windows["requests"] > 0, 0.0)
        good = ~((errors > error_rate_threshold) | (windows["latency_p95_ms"].fillna(0.0) > latency_threshold_ms)
                 | (health < health_threshold))
        rows = []
        for start, healthy in zip(windows["window_start"], good):
            if status != "in_progress":
                break
            pct = stages[idx]
            if healthy:
                done.append(pct)
                idx += 1
                if idx >= len(stages):
                    status, idx = "completed", len(stages) - 1
            else:
                status = "rolled_back"
            rows.append((key[0], start, idx, pct, bool(healthy), status, list(done)))
        if len(windows):
            last = windows["window_start"].iloc[-1].to_pydatetime()
        state.update((idx, status, done, last))
        if rows:
            yield pd.DataFrame(rows, columns=["deployment_id", "window_start", "stage_index", "percentage",
                                              "healthy", "status", "stages_completed"])

    return stage_metrics.groupBy("deployment_id").applyInPandasWithState(
        step, ROLLOUT_OUTPUT_SCHEMA, ROLLOUT_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


DEADLINE_STATE_SCHEMA = "stage_index int, status string, stages_completed array<int>, expected timestamp"


def rollout_with_deadlines(stage_metrics: DataFrame, stages: list[int], window_seconds: int, error_rate_threshold: float,
                           latency_threshold_ms: float, health_threshold: float, watermark: str = "0 seconds") -> DataFrame:
    """The canary of C04 as a stream: stage i of a deployment is its i-th window of ``window_seconds`` from its
    first one on, and a window without canary requests has no health, so its stage fails.

    ``stage_metrics`` has rows as `rollout_state_machine` takes them. A window that is left out is noticed when a
    later one arrives, or, if none does, by an event-time timer at the end of the window that is due: it
    fires once the watermark (the newest window end of any deployment, less ``watermark``) has passed it; rows that
    come later than that are dropped. One row per
    window of a deployment, empty ones included, until the rollout is completed or rolled back."""
    length = pd.Timedelta(seconds=window_seconds)

    def step(key, batches: Iterator[pd.DataFrame], state):
        idx, status, done, expected = state.get if state.exists else (0, "in_progress", [], None)
        done, rows = list(done), []
        expected = None if expected is None else pd.Timestamp(expected)

        def judge(start, healthy: bool) -> None:
            nonlocal idx, status, expected
            pct = stages[idx]
            if healthy:
                done.append(pct)
                idx += 1
                if idx >= len(stages):
                    status, idx = "completed", len(stages) - 1
            else:
                status = "rolled_back"
            rows.append((key[0], start, idx, pct, healthy, status, list(done)))
            expected = start + length

        if not state.hasTimedOut:
            for w in pd.concat(list(batches)).sort_values("window_start").itertuples():
                expected = w.window_start if expected is None else expected
                if status == "in_progress" and w.window_start > expected:
                    judge(expected, False)
                if status != "in_progress" or w.window_start < expected:
                    continue
                errors = w.errors / w.requests if w.requests else 0.0
                latency = 0.0 if pd.isna(w.latency_p95_ms) else w.latency_p95_ms
                judge(w.window_start, bool(w.requests and errors <= error_rate_threshold and latency <= latency_threshold_ms
                                           and 1.0 - errors >= health_threshold))
        passed = state.getCurrentWatermarkMs()
        due = _ms(expected + length)
        if status == "in_progress" and (state.hasTimedOut or due <= passed):
            judge(expected, False)
        state.update((idx, status, done, expected.to_pydatetime()))
        if status == "in_progress":
            state.setTimeoutTimestamp(due)
        if rows:
            yield pd.DataFrame(rows, columns=["deployment_id", "window_start", "stage_index", "percentage",
                                              "healthy", "status", "stages_completed"])

    # Event time is a window's end, so that a row is late only when the timer of its window has passed.
    ended = F.col("window_start") + F.make_interval(secs=F.lit(window_seconds))
    return stage_metrics.withColumn("__end", ended).withWatermark("__end", watermark).groupBy("deployment_id").applyInPandasWithState(
        step, ROLLOUT_OUTPUT_SCHEMA, DEADLINE_STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


def _ms(t: pd.Timestamp) -> int:
    """Epoch milliseconds of a time of the session's zone, UTC."""
    return int(t.tz_localize("UTC").timestamp() * 1000) if t.tzinfo is None else int(t.timestamp() * 1000)


# W05 ----------------------------------------------------------------------------------

def _fs(path: str):
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def _epochs(target_path: str) -> list[int]:
    """Complete gauge snapshots under ``target_path`` (``epoch=<n>`` with a _SUCCESS marker)."""
    import pyarrow.fs as pafs
    fs, base = _fs(target_path)
    try:
        infos = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    except (FileNotFoundError, OSError):
        return []
    out = []
    for i in infos:
        name = i.path.rstrip("/").split("/")[-1]
        if i.type == pafs.FileType.Directory and name.startswith("epoch="):
            if fs.get_file_info(f"{i.path}/_SUCCESS").type == pafs.FileType.File:
                out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _newest(spark: SparkSession, target_path: str) -> DataFrame:
    eps = _epochs(target_path)
    if not eps:
        raise FileNotFoundError(f"no snapshot under {target_path}")
    return spark.read.parquet(f"{target_path}/epoch={eps[-1]}")


def _snapshots(updates: DataFrame, target_path: str, checkpoint: str | None, keep: int, reduce, combine) -> None:
    """A small table kept up to date from a stream: every micro-batch is reduced, combined with the previous
    snapshot and written as snapshot ``epoch=<batch id>``. A retried batch rewrites its own
    snapshot from the untouched previous one, so nothing is lost or counted twice; readers take the newest complete
    one. The checkpoint belongs to the target (``<target_path>-checkpoint``
    unless given), so a later run resumes, takes only new input, and its epochs go on rising."""
    ckpt = checkpoint or f"{target_path.rstrip('/')}-checkpoint"

    def merge(batch: DataFrame, epoch_id: int) -> None:
        now = reduce(batch)
        prev = [e for e in _epochs(target_path) if e < epoch_id]
        if prev:
            now = combine(batch.sparkSession.read.parquet(f"{target_path}/epoch={prev[-1]}").unionByName(now))
        now.write.mode("overwrite").parquet(f"{target_path}/epoch={epoch_id}")
        fs, base = _fs(target_path)
        for old in prev[:-max(1, keep - 1)]:
            fs.delete_dir(f"{base}/epoch={old}")

    _run(updates.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt))


def read_gauges(spark: SparkSession, target_path: str) -> DataFrame:
    """The newest complete gauge snapshot."""
    return _newest(spark, target_path)


def stream_gauges(updates: DataFrame, labels: list[str], value: str, target_path: str,
                  checkpoint: str | None = None, keep: int = 2) -> None:
    """Last-value gauges (M03) kept up to date from a stream, a row per label set: the newest event time wins
    (see `_snapshots`)."""
    def last(rows: DataFrame) -> DataFrame:
        newest = F.max(F.struct("ts", value)).alias("g")
        return rows.groupBy(*labels).agg(newest).select(*labels, "g.ts", F.col(f"g.{value}").alias(value))

    _snapshots(updates.select(*labels, "ts", value), target_path, checkpoint, keep, last, last)


def stream_counters(runs: DataFrame, labels: list[str], target_path: str, checkpoint: str | None = None, keep: int = 2) -> None:
    """Counters (M01) kept up to date from a stream: a count per label set, to which every micro-batch adds its
    own once, however often it is retried (see `_snapshots`)."""
    _snapshots(runs.select(*labels), target_path, checkpoint, keep,
               lambda rows: rows.groupBy(*labels).agg(F.count(F.lit(1)).cast("bigint").alias("count")),
               lambda both: both.groupBy(*labels).agg(F.sum("count").cast("bigint").alias("count")))


def read_counters(spark: SparkSession, target_path: str) -> DataFrame:
    """The newest complete counters."""
    return _newest(spark, target_path)


def stream_histograms(runs: DataFrame, value: str, target_path: str, buckets: list[float] | None = None,
                      labels: list[str] | None = None, checkpoint: str | None = None, keep: int = 2) -> None:
    """Histograms (M02) kept up to date from a stream: bucket counts, sum and total per label set, to which every
    micro-batch adds its own once (see `_snapshots`)."""
    labels = labels or []

    def add(both: DataFrame) -> DataFrame:
        parts = [c for c in both.columns if c not in labels]
        return both.groupBy(*labels).agg(*[F.sum(c).cast(dict(both.dtypes)[c]).alias(c) for c in parts])

    _snapshots(runs.select(*labels, value), target_path, checkpoint, keep,
               lambda rows: histogram_counts(rows, value, buckets, labels), add)


def read_histograms(spark: SparkSession, target_path: str, buckets: list[float] | None = None,
                    labels: list[str] | None = None) -> DataFrame:
    """The newest complete histograms, in the rows of `duration_histogram`."""
    return histogram_rows(_newest(spark, target_path), buckets, labels)


# W06 ----------------------------------------------------------------------------------

def incremental_input(stream: DataFrame, target_path: str, checkpoint: str) -> int:
    """Append newly arrived rows to the training input (exactly once via the checkpoint);
    run on the retraining schedule with trigger availableNow. Returns rows appended by this
    run, counted in the target (from its file footers) before and after."""
    spark = stream.sparkSession

    def rows() -> int:
        try:
            return spark.read.schema(stream.schema).parquet(target_path).count()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
    before = rows()
    _run(stream.writeStream.format("parquet").option("path", target_path).option("checkpointLocation", checkpoint))
    return rows() - before
