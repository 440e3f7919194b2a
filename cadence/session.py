"""Session settings shared by library, tests and bench."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every plan in the library assumes: UTC clock (timestamps agree with DuckDB
# and with Parquet writers), ANSI arithmetic (ratios go through try_divide), AQE for
# runtime coalescing and skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers get batches of at most so many bytes, so that long texts don't pile up in one.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cadence", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster pass ``master=None`` and let spark-submit decide; locally tests use
    ``local[*]`` with few shuffle partitions.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would:
    functions run by workers import it, and only the driver's folder is sure to have it. A session that
    was built elsewhere gets the bound on their batches, which no operator changes afterwards."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_BYTES, None) != BASE_CONF[BATCH_BYTES]:
        spark.conf.set(BATCH_BYTES, BASE_CONF[BATCH_BYTES])
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cadence-package-"), "cadence_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master (tests, bench) may leave it unset; a scratch folder of that one
    machine is then created and registered. On a cluster a missing setting is an error,
    since executors would each write to their own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cadence-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Sizing for a cluster run: enough initial shuffle partitions that each holds ~128 MB
    of the input (AQE then coalesces small ones and splits skewed ones), 256 MB scan splits,
    and a broadcast threshold that only ever covers the small, size-checked tables."""
    mb = 1024 * 1024
    partitions = max(2 * total_cores, -(-input_bytes // (128 * mb)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * mb),
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
    }
