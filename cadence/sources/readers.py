"""Scans (S01-S11): CSV / Parquet / JSON / Feather, format detection, directory and mixed
directory scans, object store, JDBC and the source dispatcher.

All readers return lazy DataFrames; listings and schemas are left to Spark.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUPPORTED = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".feather": "feather"}


def detect_format(path: str) -> str:
    """Format from the suffix; unsupported suffix -> ValueError."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in SUPPORTED:
        raise ValueError(f"Unsupported file format: {ext}")
    return SUPPORTED[ext]


# What Spark says where there is no file to read.
_NOTHING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def has_files(spark: SparkSession, path: str, pattern: str = "*") -> bool:
    """Is there a file under ``path`` that matches the glob? Spark lists (on executors where there
    are many paths); one path at most comes back."""
    try:
        return bool(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
                    .select("path").limit(1).count())
    except AnalysisException as e:
        if e.getCondition() not in _NOTHING:
            raise
        return False


def _read_one(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None, **options) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", schema is None)
        return r.options(**options).csv(path)
    if fmt == "parquet":
        return r.options(**options).parquet(path)
    if fmt == "json":
        # Record-array JSON (pandas' default orient for frames written as records).
        return r.option("multiLine", options.pop("multiLine", True)).options(**options).json(path)
    if fmt == "feather":
        if schema is None:
            schema = feather_schema(spark, path)
        return read_feather(spark, path, schema)
    raise ValueError(f"Unsupported file format: {fmt}")


def read_source(spark: SparkSession, path: str, file_format: str = "auto",
                schema: T.StructType | None = None, **options) -> DataFrame:
    """One file or a directory of one format. ``auto`` detects by suffix; for a
    directory (no suffix) the format is detected from the files it contains."""
    fmt = file_format
    if fmt == "auto":
        if os.path.splitext(path.rstrip("/"))[1]:
            fmt = detect_format(path)
        else:
            found = {fmt for ext, fmt in SUPPORTED.items() if has_files(spark, path, f"*{ext}")}
            if len(found) != 1:
                raise ValueError(f"cannot detect one format in directory {path}: {sorted(found)}")
            fmt = found.pop()
    if fmt not in SUPPORTED.values():
        raise ValueError(f"Unsupported file format: {fmt}")
    glob = {"csv": "*.csv", "parquet": "*.parquet", "json": "*.json", "feather": "*.feather"}[fmt]
    if fmt != "feather" and not os.path.splitext(path.rstrip("/"))[1]:
        options.setdefault("pathGlobFilter", glob)
    return _read_one(spark, path, fmt, schema, **options)


_WIDEN_ORDER = [T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    ia = next((i for i, t in enumerate(_WIDEN_ORDER) if isinstance(a, t)), None)
    ib = next((i for i, t in enumerate(_WIDEN_ORDER) if isinstance(b, t)), None)
    if ia is not None and ib is not None:
        return _WIDEN_ORDER[max(ia, ib)]()
    return T.StringType()


def union_by_name(dfs: list[DataFrame], widen_missing_ints: bool = True) -> DataFrame:
    """S07 core: outer union by column name; missing columns NULL; types widened to a common
    type; integral columns that receive NULLs from the union become double (as a pandas
    concat turns them into float64)."""
    if not dfs:
        raise ValueError("nothing to union")
    types: dict[str, T.DataType] = {}
    order: list[str] = []
    for d in dfs:
        for f in d.schema.fields:
            if f.name not in types:
                types[f.name] = f.dataType
                order.append(f.name)
            else:
                types[f.name] = _wider(types[f.name], f.dataType)
    if widen_missing_ints:
        for c in order:
            missing_somewhere = any(c not in d.columns for d in dfs)
            if missing_somewhere and isinstance(types[c], (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
                types[c] = T.DoubleType()
    aligned = [d.select(*[(F.col(c).cast(types[c]) if c in d.columns else F.lit(None).cast(types[c])).alias(c)
                          for c in order]) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b), aligned)


MAX_HEADERS = 1_000   # different CSV headers in one directory


def _csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every CSV file under ``path``."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    first = lines.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    return first.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def _read_csv_directory(spark: SparkSession, path: str) -> list[DataFrame]:
    """One scan of the directory if its CSV files share their header; else one scan per header,
    of the files that have it (their names are then gathered on the driver)."""
    headers = _csv_headers(spark, path)
    seen = sorted(r["header"] for r in headers.select("header").distinct().limit(MAX_HEADERS + 1).collect())
    if len(seen) > MAX_HEADERS:
        raise ValueError(f"over {MAX_HEADERS} different CSV headers in {path}")
    if len(seen) == 1:
        return [_read_one(spark, path, "csv", None, pathGlobFilter="*.csv")]
    files = {h: [r["file"] for r in headers.where(F.col("header") == h).select("file").collect()] for h in seen}
    return [spark.read.option("header", True).option("inferSchema", True).csv(sorted(f)) for f in files.values()]


def read_mixed_directory(spark: SparkSession, path: str) -> DataFrame | None:
    """All ``*.parquet`` and all ``*.csv`` files of a directory, unioned by name. One
    scan for Parquet (schemas merged) and one for each CSV header, however many files there
    are. Returns None for a directory without data files."""
    found = []
    if has_files(spark, path, "*.parquet"):
        found.append(spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", True).parquet(path))
    if has_files(spark, path, "*.csv"):
        found += _read_csv_directory(spark, path)
    return union_by_name(found) if found else None


def require_data(df: DataFrame | None, path: str) -> DataFrame:
    """S08 for pipelines: no data files is an error."""
    if df is None:
        raise FileNotFoundError(f"No data files found in {path}")
    return df


def read_object(spark: SparkSession, bucket: str, key: str, file_format: str | None = None,
                scheme: str = "s3a") -> DataFrame:
    """Object-store scan through the Hadoop connector (``fs.s3a.*`` settings give the
    endpoint and credentials). The format follows the key's suffix unless given."""
    fmt = file_format or (detect_format(key) if os.path.splitext(key)[1] else "parquet")
    return _read_one(spark, f"{scheme}://{bucket}/{key}", fmt, None)


def read_database(spark: SparkSession, query: str, url: str | None = None, properties: dict | None = None,
                  partition_column: str | None = None, lower_bound: int | None = None,
                  upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """JDBC scan of a SQL query. The URL comes from the argument or ``DATABASE_URL``;
    without one this is an error. With a partition column the read is split into
    ``num_partitions`` parallel range queries."""
    url = url or os.environ.get("DATABASE_URL")
    if not url:
        raise ValueError("Database connection string not provided")
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) AS q").option("partitionColumn", partition_column)
             .option("lowerBound", lower_bound).option("upperBound", upper_bound)
             .option("numPartitions", num_partitions or 8))
    else:
        r = r.option("query", query)
    return r.load()


def load_training_data(spark: SparkSession, source: str, config: dict | None = None) -> DataFrame:
    """``s3://bucket/key`` goes to the object store (format by suffix), anything else
    to the file readers. A path without a data suffix is a directory, which may mix Parquet and
    CSV; no data in it is an error (S08)."""
    config = config or {}
    if source.startswith("s3://"):
        bucket, _, key = source[len("s3://"):].partition("/")
        return read_object(spark, bucket, key, config.get("file_format"))
    suffix = os.path.splitext(source.rstrip("/"))[1].lower()
    if suffix not in SUPPORTED and config.get("file_format") in (None, "auto"):
        return require_data(read_mixed_directory(spark, source), source)
    return read_source(spark, source, config.get("file_format", "auto"))


# ----------------------------------------------------------------------------------------
# Feather (Arrow IPC) as a parallel scan: one task per file, decoded inside the task.

def feather_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the Feather files at ``path``: a task opens one of them, and only its Arrow
    schema reaches the driver."""
    import pyarrow.ipc as ipc
    from pyspark.sql.pandas.types import from_arrow_schema

    def head(batches):
        import pyarrow as pa
        for b in batches:
            for content in b.column(0):
                yield pa.RecordBatch.from_pydict({"schema": [ipc.open_file(content.as_buffer()).schema.serialize().to_pybytes()]})

    found = _feather_files(spark, path).select("content").limit(1).mapInArrow(head, "schema binary").collect()
    if not found:
        raise FileNotFoundError(f"No Feather files found in {path}")
    return from_arrow_schema(ipc.read_schema(pa_buffer(found[0]["schema"])))


def pa_buffer(data: bytes):
    import pyarrow as pa
    return pa.py_buffer(bytes(data))


def _feather_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.feather").load(path)


def read_feather(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``binaryFile`` gives every file as a row, and tasks decode them (``decode_feather``).
    A file is read whole by its task, as binaryFile rows are."""
    return decode_feather(_feather_files(spark, path).select("content"), schema)


def decode_feather(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of Feather (Arrow IPC) files given as a binary column ``content``, batch by batch."""
    names = [f.name for f in schema.fields]

    def decode(batches):
        import pyarrow as pa
        import pyarrow.ipc as ipc
        for b in batches:
            for content in b.column("content"):
                reader = ipc.open_file(content.as_buffer())
                for i in range(reader.num_record_batches):
                    rb = reader.get_batch(i)
                    yield pa.RecordBatch.from_arrays([rb.column(rb.schema.get_field_index(n)) for n in names],
                                                     names=names)

    return files.select("content").mapInArrow(decode, schema)
