import pytest
from pyspark.sql import functions as F

from cadence.functions.quantiles import exact_quantiles, grouped_quantiles

def test_exact_quantiles_match_percentile(spark):
    df = spark.range(1001).select((F.col("id") * 7919 % 1009).cast("double").alias("x"),
                                  (F.col("id") % 3).alias("g"))
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.95, 1.0], ["g"]).collect()}
    ref = {r["g"]: r["q"] for r in df.groupBy("g").agg(
        F.percentile("x", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.95, 1.0)])).alias("q")).collect()}
    for g in ref:
        assert got[g] == pytest.approx(ref[g], abs=1e-9)


def test_empty_and_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None)], "g string, x double")
    got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got[None] == (2, [2.0])
    assert "a" not in got          # no values in that group: absent from the counts


def test_nan_and_null_are_missing_and_partitions_do_not_matter(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", float("nan")), ("a", None), ("b", float("nan"))],
                               "g string, x double")
    for parts in (1, 7):
        got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["x"], [0.5, 0.95], ["g"], parts).collect()}
        assert got == {"a": (3, [2.0, pytest.approx(2.9)])}
    both = grouped_quantiles(df, [F.count(F.lit(1)).alias("n")], ["x"], [0.5], ["g"]).collect()
    assert {r["g"]: (r["n"], r["q_x"]) for r in both} == {"a": (5, [2.0]), "b": (1, None)}


def test_hot_value_is_one_row(spark):
    """Two thirds of 300,000 rows are zero; the wanted ranks fall before, in and behind them."""
    df = spark.range(300_000).select(F.when(F.col("id") % 3 > 0, 0.0).otherwise(F.col("id") - 150_000.0).alias("x"))
    probs = [0.0, 0.1, 0.166, 0.5, 0.834, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs).first()
    want = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("q")).first()["q"]
    assert got["n"] == 300_000 and got["quantiles"] == pytest.approx(want, abs=1e-6)
