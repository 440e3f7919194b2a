"""Goldens on a table of the size and shape of FIXTURES.md section 2 (768 rows, zeros that stand for
missing values), written as CSV by a rule; pandas gives the expected values."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadence.operators.impute import fit_missing, apply_missing, zero_as_missing
from cadence.operators.split import content_key, hash_split
from cadence.operators.validate import DataSchema, duplicate_ratio, numeric_summary, validate
from cadence.sources import read_source

ZERO_COLS = ["Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"]


def frame():
    rng = np.random.default_rng(42)
    d = pd.DataFrame({c: rng.normal(m, sd, 768).round(1 if c == "BMI" else 0).clip(1) for c, m, sd in (
        ("Glucose", 121, 30), ("BloodPressure", 72, 12), ("SkinThickness", 29, 9), ("Insulin", 140, 60), ("BMI", 32, 7))})
    for c, n in zip(ZERO_COLS, (5, 35, 227, 374, 11)):
        d.loc[rng.choice(768, n, replace=False), c] = 0
    d["Age"] = rng.integers(21, 80, 768) + np.arange(768) / 1000  # no two rows are equal
    d["Outcome"] = (d["Glucose"] + rng.normal(0, 20, 768) > 130).astype(int)
    return d


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    p = str(tmp_path_factory.mktemp("raw") / "measurements.csv")
    frame().to_csv(p, index=False)
    return p


@pytest.fixture(scope="module")
def diabetes(spark, path):
    return read_source(spark, path)


def test_raw_profile(diabetes):
    assert diabetes.count() == 768
    assert duplicate_ratio(diabetes).first()["duplicates"] == 0
    assert {r["Outcome"]: r["count"] for r in diabetes.groupBy("Outcome").count().collect()} == \
        frame()["Outcome"].value_counts().to_dict()
    zeros = diabetes.agg(*[F.count_if(F.col(c) == 0).alias(c) for c in ZERO_COLS]).first().asDict()
    assert zeros == {"Glucose": 5, "BloodPressure": 35, "SkinThickness": 227, "Insulin": 374, "BMI": 11}
    f, s = validate(diabetes, DataSchema(target_column="Outcome"))
    assert s.first()["is_valid"] and f.where("check = 'null_ratio'").count() == 0


def test_raw_glucose_summary(diabetes):
    g = {r["column"]: r for r in numeric_summary(diabetes, ["Glucose"]).collect()}["Glucose"]
    w = frame()["Glucose"].describe()
    assert [round(g[c], 6) for c in ("mean", "std", "p25", "p50", "p75", "max")] == \
        [round(w[c], 6) for c in ("mean", "std", "25%", "50%", "75%", "max")]


def test_zero_as_missing_median_then_moments(diabetes):
    z = zero_as_missing(diabetes, ZERO_COLS)
    fitted = fit_missing(z, "median")
    want = frame()[ZERO_COLS].replace(0, np.nan)
    assert {c: fitted.fills[c] for c in ZERO_COLS} == want.median().to_dict()
    want = want.fillna(want.median())
    imp = apply_missing(z, fitted)
    got = imp.agg(*[F.avg(c).alias(f"m_{c}") for c in ZERO_COLS],
                  *[F.stddev_pop(c).alias(f"s_{c}") for c in ZERO_COLS]).first()
    for c in ZERO_COLS:
        assert got[f"m_{c}"] == pytest.approx(want[c].mean()) and got[f"s_{c}"] == pytest.approx(want[c].std(ddof=0))


def test_exact_split_sizes(diabetes):
    keyed = diabetes.withColumn("row_key", content_key(diabetes.columns))
    s = hash_split(keyed, "row_key", 0.15, 0.15, exact=True)
    assert {r["split"]: r["count"] for r in s.groupBy("split").count().collect()} == \
        {"train": 536, "val": 116, "test": 116}


def test_whole_raw_directory_union(spark, path):
    """Three tables of different columns in one folder, as CSV."""
    from cadence.sources import read_mixed_directory
    folder = os.path.dirname(path)
    pd.DataFrame({"interaction_id": range(30), "interaction_type": ["view"] * 22 + ["apply"] * 8}).to_csv(f"{folder}/i.csv", index=False)
    pd.DataFrame({"job_id": range(30), "salary_min": range(30)}).to_csv(f"{folder}/j.csv", index=False)
    df = read_mixed_directory(spark, folder)
    assert df.count() == 768 + 30 + 30
    assert {"Glucose", "interaction_type", "salary_min"} <= set(df.columns)
    by_type = {r["interaction_type"]: r["count"] for r in df.where("interaction_type IS NOT NULL")
               .groupBy("interaction_type").count().collect()}
    assert by_type == {"view": 22, "apply": 8}


def test_training_cycle_on_diabetes(spark, tmp_dir, path):
    from cadence.operators.lifecycle import training_cycle
    from cadence.operators.registry_store import RegistryStore
    store = RegistryStore(spark, os.path.join(tmp_dir, "registry"))
    df = read_source(spark, path)
    df = df.withColumn("row_key", content_key(df.columns))
    loose = {"min_accuracy": 0.5, "min_f1": 0.5, "min_precision": 0.0, "min_recall": 0.0}
    first = training_cycle(df, "row_key", "Outcome", store, "diabetes", zero_as_missing_columns=ZERO_COLS,
                           thresholds=loose, hidden=[16], max_iter=50)
    assert first["status"] == "FINISHED" and first["version"] == 1
    assert first["new_stage"] == "Production" and first["reason"] == "No production model exists"
    assert 0.6 < first["metrics"]["accuracy"] <= 1.0
    second = training_cycle(df, "row_key", "Outcome", store, "diabetes", zero_as_missing_columns=ZERO_COLS,
                            thresholds=loose, hidden=[16], max_iter=50)
    champ_val = {r["metric"]: r["value"] for r in store.latest_metrics().where(f"run_id = '{first['run_id']}'").collect()}
    expect_better = second["metrics"]["accuracy"] - champ_val["final_accuracy"] >= 0.01   # D12 rule
    assert second["version"] == 2 and second["is_better"] == expect_better
    assert second["new_stage"] == ("Production" if expect_better else "Staging")
    stages = {r["version"]: r["stage"] for r in store.versions().collect()}
    assert stages == ({1: "Archived", 2: "Production"} if expect_better else {1: "Production", 2: "Staging"})
    assert {r["status"] for r in store.runs().collect()} == {"FINISHED"}
    assert store.latest_metrics().where("metric = 'final_accuracy'").count() == 2
    store.transition("diabetes", 1, "Production")
    assert {r["version"]: r["stage"] for r in store.versions().collect()}[1] == "Production"
    assert sum(r["stage"] == "Production" for r in store.versions().collect()) == 1
