import random

import pytest

from cadence.operators.validate import (DataSchema, duplicate_ratio, findings, numeric_summary,
                                        top_values, validate, validate_splits)


def test_valid_random_table(spark):
    rnd = random.Random(7)
    rows = [(rnd.random(), rnd.random(), rnd.randint(0, 1)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "feature1 double, feature2 double, target int")
    schema = DataSchema(required_columns=["feature1", "feature2", "target"],
                        numeric_columns=["feature1", "feature2"], target_column="target")
    f, s = validate(df, schema)
    r = s.first()
    assert r["is_valid"] and r["num_samples"] == 1000 and r["num_features"] == 3
    assert f.where("severity = 'error'").count() == 0


def test_too_few_rows(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.random(),) for _ in range(50)], "feature1 double")
    f, s = validate(df, DataSchema(min_rows=100))
    assert not s.first()["is_valid"]
    msgs = [r["message"] for r in f.collect()]
    assert "Insufficient data: 50 rows (minimum: 100)" in msgs


def test_checks_do_not_short_circuit(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "x", 1), (1.0, "x", 1), (None, "x", 1)],
                               "a double, s string, k int")
    schema = DataSchema(required_columns=["a", "zz"], numeric_columns=["s", "k"], target_column="t", min_rows=1)
    f, _ = findings(df, schema)
    got = {(r["check"], r["column"], r["severity"]) for r in f.collect()}
    assert ("schema", "zz", "error") in got
    assert ("schema", "s", "error") in got          # string listed as numeric
    assert ("schema", "t", "error") in got
    assert ("null_ratio", "a", "error") in got      # 75 % > 30 %
    assert ("duplicates", None, "warning") in got   # 2 of 4 rows repeat
    assert ("constant", "s", "warning") in got
    assert ("zero_variance", "k", "warning") in got
    assert ("zero_variance", "s", "warning") not in got
    msgs = {r["message"] for r in f.collect()}
    assert "Column 'a' has 75.0% null values (max: 30.0%)" in msgs


def test_null_warning_between_10_and_max(spark):
    rows = [(None,)] * 2 + [(1.0,)] * 8
    f, _ = findings(spark.createDataFrame(rows, "a double"), DataSchema(min_rows=1))
    (r,) = [x for x in f.collect() if x["check"] == "null_ratio"]
    assert r["severity"] == "warning" and r["message"] == "Column 'a' has 20.0% null values"


def test_parameter_check():
    with pytest.raises(ValueError):
        DataSchema(max_null_ratio=1.5)


def test_duplicates_nulls_compare_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 3)], "a int, b int")
    r = duplicate_ratio(df).first()
    assert (r["n"], r["duplicates"]) == (3, 1)
    assert duplicate_ratio(spark.createDataFrame([], "a int")).first()["duplicate_ratio"] == 0.0


def test_numeric_summary_interpolates(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    r = numeric_summary(df).first()
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 2.5, 3.25)
    assert abs(r["std"] - 1.2909944487358056) < 1e-12


def test_top_values_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    rows = [(r["value"], r["count"], r["rank"], r["unique_values"]) for r in top_values(df, k=2).orderBy("rank").collect()]
    assert rows == [("c", 2, 1, 3), ("a", 1, 2, 3)]


def test_split_validation(spark):
    df = spark.createDataFrame([(1, "train", 1.0), (1, "test", 2.0), (2, "val", None)], "k int, split string, f double")
    out = {r["split"]: r for r in validate_splits(df, "k").collect()}
    assert out["val"]["rows_with_nulls"] == 1 and out["train"]["shared_keys"] == 1
    assert not out["train"]["valid"]


def test_duplicates_tell_null_places_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", None), (None, None), (None, None), ("a", "a")], "x string, y string")
    r = duplicate_ratio(df).first()
    assert (r["n"], r["duplicates"]) == (6, 2)
