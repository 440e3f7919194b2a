import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadence.sources import (detect_format, load_training_data, read_mixed_directory, read_source,
                             require_data, union_by_name, write_splits)


def _small():
    return pd.DataFrame({"width": [11, 12, 14, 17], "height": [0.5, 1.5, 2.5, 4.5], "grade": ["b", "a", "c", "a"]})


def test_csv_scan_keeps_rows_and_column_order(spark, tmp_dir):
    p = os.path.join(tmp_dir, "d.csv")
    _small().to_csv(p, index=False)
    df = read_source(spark, p)
    assert df.count() == 4
    assert df.columns == ["width", "height", "grade"]
    assert dict(df.dtypes) == {"width": "int", "height": "double", "grade": "string"}


def test_parquet_and_json_scan(spark, tmp_dir):
    p = os.path.join(tmp_dir, "d.parquet")
    _small().to_parquet(p, index=False)
    assert read_source(spark, p).count() == 4
    j = os.path.join(tmp_dir, "d.json")
    _small().to_json(j, orient="records")
    assert sorted(r["width"] for r in read_source(spark, j).collect()) == [11, 12, 14, 17]


def test_feather_scan_is_parallel_and_typed(spark, tmp_dir):
    d = os.path.join(tmp_dir, "feather")
    os.makedirs(d)
    for i in range(3):
        _small().assign(width=lambda x, i=i: x.width + 10 * i).to_feather(os.path.join(d, f"p{i}.feather"))
    df = read_source(spark, d, "feather")
    assert df.count() == 12 and dict(df.dtypes) == {"width": "bigint", "height": "double", "grade": "string"}
    assert sorted(r["width"] for r in df.collect())[-1] == 37
    assert read_source(spark, d).count() == 12 and read_source(spark, os.path.join(d, "p1.feather")).count() == 4
    with pytest.raises(FileNotFoundError):
        read_source(spark, tmp_dir, "feather")


def test_unsupported_format():
    with pytest.raises(ValueError, match="Unsupported file format"):
        detect_format("x.xlsx")


def test_mixed_directory_union_by_name(spark, tmp_dir):
    pd.DataFrame({"a": [1, 2], "b": [1.5, 2.5]}).to_parquet(os.path.join(tmp_dir, "p.parquet"), index=False)
    pd.DataFrame({"a": [3], "c": ["x"]}).to_csv(os.path.join(tmp_dir, "q.csv"), index=False)
    df = read_mixed_directory(spark, tmp_dir)
    assert df.count() == 3
    assert set(df.columns) == {"a", "b", "c"}
    assert dict(df.dtypes)["b"] == "double"
    rows = {r["a"]: r for r in df.collect()}
    assert rows[3]["b"] is None and rows[1]["c"] is None


def test_union_widens_ints_with_missing_values(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    u = union_by_name([a, b])
    assert dict(u.dtypes) == {"x": "int", "y": "double"}


def test_empty_directory(spark, tmp_dir):
    assert read_mixed_directory(spark, tmp_dir) is None
    with pytest.raises(FileNotFoundError):
        require_data(None, tmp_dir)
    with pytest.raises(FileNotFoundError):
        load_training_data(spark, tmp_dir)


def test_split_sink_target_last(spark, tmp_dir):
    df = spark.createDataFrame([(1, 0, "train", 1.0), (2, 1, "test", 2.0)], "k int, y int, split string, f double")
    paths = write_splits(df, os.path.join(tmp_dir, "out"), "y")
    back = spark.read.parquet(paths["train"])
    assert back.columns[-1] == "y"


def test_database_and_object_store_arguments(spark, monkeypatch):
    import cadence.sources.readers as R
    monkeypatch.delenv("DATABASE_URL", raising=False)
    with pytest.raises(ValueError, match="connection string"):
        R.read_database(spark, "SELECT 1")
    seen = {}
    monkeypatch.setattr(R, "_read_one", lambda s, path, fmt, schema, **o: seen.update(path=path, fmt=fmt) or "df")
    assert R.load_training_data(spark, "s3://bucket/data/train.csv") == "df"
    assert seen == {"path": "s3a://bucket/data/train.csv", "fmt": "csv"}       # suffix decides, not "always parquet"
    R.load_training_data(spark, "s3://bucket/data/part")
    assert seen["fmt"] == "parquet"


def test_object_store_scan_through_another_scheme(spark, tmp_dir):
    """The object reader takes its scheme as an argument; ``file`` needs no store."""
    from cadence.sources.readers import read_object
    _small().to_csv(os.path.join(tmp_dir, "d.csv"), index=False)
    _small().to_parquet(os.path.join(tmp_dir, "part"), index=False)
    assert read_object(spark, tmp_dir, "d.csv", scheme="file").count() == 4
    assert read_object(spark, tmp_dir, "part", scheme="file").columns == ["width", "height", "grade"]


def test_directory_of_many_csv_files_with_three_headers(spark, tmp_dir):
    for i in range(30):
        d = _small().assign(**{"n": i}) if i % 3 else _small()[["grade", "width"]] if i % 2 else _small()
        d.to_csv(os.path.join(tmp_dir, f"f{i}.csv"), index=False)
    df = read_mixed_directory(spark, tmp_dir)
    assert df.count() == 120 and set(df.columns) == {"width", "height", "grade", "n"}
    assert df.where("n is null").count() == 40 and df.where("height is null").count() == 20
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3


def test_append_log(spark, tmp_dir):
    from cadence.sources.sinks import append_log
    for _ in range(2):
        append_log(spark.createDataFrame(_small()), os.path.join(tmp_dir, "log"))
    assert spark.read.parquet(os.path.join(tmp_dir, "log")).count() == 8


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from cadence.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)


def test_feather_is_split_by_record_batches(spark, tmp_dir):
    import pandas as pd
    import pyarrow.feather as feather

    from cadence.sources.feather import read_feather_batches
    for k in range(2):
        frame = pd.DataFrame({"i": range(k * 5000, (k + 1) * 5000), "s": [f"text {j} é" if j % 7 else None for j in range(5000)], "x": 0.5})
        feather.write_feather(frame, os.path.join(tmp_dir, f"p{k}.feather"), compression="zstd" if k else "uncompressed", chunksize=100)
    df = read_feather_batches(spark, tmp_dir, part_bytes=8 << 10)
    assert df.rdd.getNumPartitions() > 10 and df.columns == ["i", "s", "x"]  # one file, many tasks
    assert df.agg(F.count("i"), F.count("s"), F.sum("i"), F.sum("x")).first()[0:4] == (10_000, 2 * (5000 - 715), sum(range(10_000)), 5000.0)
    narrow = read_feather_batches(spark, os.path.join(tmp_dir, "p1.feather"), ["s", "i"])
    assert narrow.columns == ["s", "i"] and narrow.where("i = 5001").first().s == "text 1 é"
    with pytest.raises(FileNotFoundError):
        read_feather_batches(spark, os.path.join(tmp_dir, "none"))
