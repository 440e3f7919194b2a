import math

import pytest
from pyspark.sql import functions as F

from cadence.operators.encode import apply_label_codes, fit_label_codes, label_encode, one_hot
from cadence.operators.features import create_features
from cadence.operators.impute import drop_missing, fill_missing, handle_missing_values, zero_as_missing
from cadence.operators.scale import minmax_scale, standard_scale


@pytest.fixture()
def missing_small(spark):
    return spark.createDataFrame([(1.0, "a"), (2.0, None), (None, "b"), (4.0, "a")],
                                 "numeric double, category string")


def test_mean_impute_golden(missing_small):
    rows = handle_missing_values(missing_small, "mean").collect()
    assert abs(rows[2]["numeric"] - 7 / 3) < 1e-12
    assert rows[1]["category"] == "a"
    assert all(r["numeric"] is not None and r["category"] is not None for r in rows)


def test_median_impute_golden(missing_small):
    rows = handle_missing_values(missing_small, "median").collect()
    assert rows[2]["numeric"] == 2.0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert [r["x"] for r in handle_missing_values(df, "mean").collect()] == [1.0, 2.0, 3.0]


def test_int_column_with_nulls_widens(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    out = handle_missing_values(df, "mean")
    assert dict(out.dtypes)["x"] == "double"
    assert out.collect()[1]["x"] == 1.5


def test_mode_ties_smallest_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "c string, z double")
    out = handle_missing_values(df, "mode", fill_value=-1).collect()
    assert out[2]["c"] == "a"
    assert out[0]["z"] == -1.0


def test_all_null_numeric_stays_null_and_categorical_unknown(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, c string")
    out = handle_missing_values(df, "mean").collect()
    assert out[0]["x"] is None and out[0]["c"] == "unknown"


def test_fill_and_drop(missing_small):
    f = fill_missing(missing_small, 0).collect()
    assert f[2]["numeric"] == 0.0 and f[1]["category"] == "0"
    assert drop_missing(missing_small).count() == 2
    with pytest.raises(ValueError):
        fill_missing(missing_small, None)
    with pytest.raises(ValueError, match="Unknown strategy"):
        handle_missing_values(missing_small, "bogus")


def test_zero_as_missing(spark):
    df = spark.createDataFrame([(0.0, 1), (2.0, 0)], "a double, b int")
    r = zero_as_missing(df, ["a", "b", "not_there"]).collect()
    assert r[0]["a"] is None and r[1]["b"] is None


def test_label_codes_golden_and_unseen(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "category string")
    codes = fit_label_codes(df)
    assert [r[0] for r in apply_label_codes(df, codes).collect()] == [0, 1, 2, 0]
    new = spark.createDataFrame([("d",)], "category string")
    with pytest.raises(Exception, match="unseen"):
        apply_label_codes(new, codes).collect()
    assert apply_label_codes(new, codes, handle_unknown="keep").collect()[0][0] == -1


def test_label_codes_null_token_and_large_table(spark, monkeypatch):
    import cadence.operators.encode as enc
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    # NULL is encoded as the text "None", which sorts before lower-case letters.
    assert [r[0] for r in label_encode(df).collect()] == [2, 0, 1]
    monkeypatch.setattr(enc, "INLINE_MAX", 1)
    big = spark.createDataFrame([(f"v{i:03d}",) for i in range(50)], "c string")
    codes = enc.fit_label_codes(big)
    assert "c" in codes.tables
    out = [r[0] for r in enc.apply_label_codes(big, codes).collect()]
    assert out == list(range(50))
    monkeypatch.setattr(enc, "BROADCAST_MAX_ROWS", 10)     # distributed ranking path
    codes = enc.fit_label_codes(big.repartition(5))
    assert sorted(r[0] for r in enc.apply_label_codes(big, codes).collect()) == list(range(50))
    assert [r[0] for r in enc.apply_label_codes(big, codes).orderBy("c").collect()] == list(range(50))


def test_one_hot(spark):
    df = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "c string, k int")
    oh = one_hot(df, ["c"])
    assert oh.columns == ["k", "c_x", "c_y"]
    assert [tuple(r) for r in oh.collect()] == [(1, True, False), (2, False, False), (3, False, True)]


def test_standard_scale_golden(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "feature bigint")
    vals = [r[0] for r in standard_scale(df).collect()]
    assert [round(v, 6) for v in vals] == [-1.414214, -0.707107, 0.0, 0.707107, 1.414214]
    mean = sum(vals) / 5
    pop = math.sqrt(sum((v - mean) ** 2 for v in vals) / 5)
    samp = math.sqrt(sum((v - mean) ** 2 for v in vals) / 4)
    assert abs(pop - 1) < 1e-9 and abs(samp - 1.118034) < 1e-6


def test_scale_zero_variance_and_minmax(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 3.0)], "c double, m double")
    assert [r[0] for r in standard_scale(df, ["c"]).collect()] == [0.0, 0.0]
    assert [r["m"] for r in minmax_scale(df, ["m"]).collect()] == [0.0, 1.0]
    assert [r["c"] for r in minmax_scale(df, ["c"]).collect()] == [0.0, 0.0]


def test_features_and_date_parts(spark):
    import datetime as dt
    df = spark.createDataFrame([(2.0, 3.0, dt.datetime(2024, 1, 1))], "a double, b double, t timestamp")
    r = create_features(df, [("a", "b"), ("a", "zz")], ["a"]).collect()[0]
    assert r["a_x_b"] == 6.0 and r["a_squared"] == 4.0
    assert (r["t_year"], r["t_month"], r["t_day"], r["t_dayofweek"]) == (2024, 1, 1, 0)  # Monday = 0


def test_prepare_fitted_on_train_does_not_leak(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cadence.operators.prepare import Preprocessor, prepare
    df = spark.range(400).selectExpr("concat('key', id) as k", "case when id % 4 > 0 then cast(id as double) end as x",
                                     "case when id % 2 = 0 then 'a' else 'b' end as c", "cast(id % 3 as int) as y")
    out, tgt, pre = prepare(df, "k", "y", fit_on="train")
    train = out.where("split = 'train'").select("k")
    mean = df.join(train, "k").agg(F.avg("x")).first()[0]
    assert pre.imputation.fills["x"] == mean and pre.imputation.fills["x"] != df.agg(F.avg("x")).first()[0]
    assert {r["k"] for r in out.collect()} == {f"key{i}" for i in range(400)}      # keys come out as they went in
    more = df.unionByName(spark.range(400, 500).selectExpr("concat('key', id) as k", "cast(id as double) as x", "'a' as c", "1 as y"))
    again = {r["k"]: r["split"] for r in prepare(more, "k", "y")[0].collect()}
    assert all(again[r["k"]] == r["split"] for r in out.collect())                # a row keeps its split
    pre.save(spark, tmp_dir + "/state")
    same = Preprocessor.load(spark, tmp_dir + "/state").transform(df)
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, pre.transform(df).collect()), key=str)


def test_one_hot_of_new_data_has_the_fitted_columns(spark):
    from cadence.operators.prepare import Preprocessor
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "c string, v double")
    b = spark.createDataFrame([("z", 3.0), ("x", 4.0)], "c string, v double")
    pre = Preprocessor(encoding_method="onehot").fit(a)
    assert pre.transform(b).columns == pre.transform(a).columns == ["v", "c_x", "c_y"]


def test_mode_of_large_integers(spark):
    from cadence.operators.impute import column_modes
    big = 2**53 + 1
    df = spark.createDataFrame([(big, True), (big, True), (big - 1, False), (None, None)], "v long, b boolean")
    assert column_modes(df, ["v", "b"]) == {"v": big, "b": True}


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k long, a double, i int, z double, s string, split string")


def test_later_rows_get_the_fitted_values(spark):
    """Columns without a missing value when fitted still fill later ones; new zeros count as missing."""
    from cadence.operators.prepare import Preprocessor
    seen = [(k, float(k % 5), k % 4, float(1 + k % 3), "xyy"[k % 3], "train") for k in range(60)]
    for strategy, a, i in (("mean", 2.0, 1.5), ("median", 2.0, 1.5), ("mode", 0.0, 0)):
        pre = Preprocessor(strategy, zero_as_missing_columns=["z"], keys=["k", "split"], scaling_method="minmax").fit(_batch(spark, seen))
        later = _batch(spark, [(100, None, None, 0.0, None, "val"), (101, float("nan"), 3, None, "x", "val")])
        rows = {r.k: r for r in pre.transform(later).collect()}
        assert (rows[100].a, rows[100].i, rows[100].z, rows[100].s) == (a / 4, pytest.approx(i / 3), 0.5, 1.0)
        assert (rows[101].a, rows[101].i, rows[101].s) == (a / 4, 1.0, 0.0)
        assert rows[101].z == (0.5 if strategy != "mode" else 0.0)


def test_update_equals_a_fit_on_all_rows(spark, tmp_dir):
    from cadence.operators.prepare import Preprocessor
    import random
    rng = random.Random(3)
    value = lambda: rng.choice([None, 0.0, float("nan"), *[rng.gauss(50, 9)] * 4])
    rows = [(k, value(), rng.choice([None, 0, 3, 8]), value(), rng.choice([None, "p", "q", f"v{k}"]), "train") for k in range(1500)]
    for strategy in ("mean", "median", "mode"):
        settings = dict(missing_strategy=strategy, zero_as_missing_columns=["z"], keys=["k", "split"])
        Preprocessor(**settings).fit(_batch(spark, rows[:400])).save(spark, f"{tmp_dir}/{strategy}")
        grown = Preprocessor.load(spark, f"{tmp_dir}/{strategy}").update(_batch(spark, rows[400:700])).update(_batch(spark, rows[700:]))
        whole = Preprocessor(**settings).fit(_batch(spark, rows))
        assert grown.imputation.fills.keys() == whole.imputation.fills.keys() == {"a", "i", "z", "s"}
        for c, v in whole.imputation.fills.items():
            assert grown.imputation.fills[c] == (pytest.approx(v, rel=0.02) if strategy == "median" and c in "az" else v if c == "s" else pytest.approx(v))
        assert grown.zero_imputation.fills["z"] == pytest.approx(whole.zero_imputation.fills["z"], rel=0.02)
        assert whole.codes.sizes["s"] > 256  # a code table
        assert {r.value: r.code for r in grown.codes.tables["s"].collect()} == {r.value: r.code for r in whole.codes.tables["s"].collect()}
        # The closed form of the moments is that of the filled rows.
        filled = whole.transform(_batch(spark, rows))
        for c in ("a", "i", "z", "s"):
            m = filled.select(F.avg(c), F.stddev_pop(c)).first()
            assert (m[0], m[1]) == (pytest.approx(0, abs=1e-9), pytest.approx(1, abs=1e-9))
            assert filled.where(F.col(c).isNull()).count() == 0


def test_one_hot_vectors_beyond_the_column_limit(spark):
    from pyspark.ml.functions import vector_to_array

    from cadence.operators.encode import apply_one_hot_vectors, fit_one_hot_vectors
    rows = [(i, f"v{i % 1000}" if i % 11 else None, "None" if i % 2 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, wide string, small string")
    with pytest.raises(ValueError, match="one_hot_vectors"):
        one_hot(df, ["wide"])
    fitted = fit_one_hot_vectors(df, ["wide", "small"])
    assert fitted.sizes == {"wide": 1000, "small": 2}
    out = apply_one_hot_vectors(df, fitted)
    assert out.columns == ["k", "wide_vector", "small_vector"]
    order = {v: i for i, v in enumerate(sorted({r[1] for r in rows if r[1]}))}
    for r in out.collect():
        wide, small = rows[r.k][1], rows[r.k][2]
        assert (r.wide_vector.size, r.wide_vector.indices.tolist()) == (1000, [order[wide]] if wide else [])
        assert vector_to_array and r.small_vector.toArray().tolist() == ([1.0, 0.0] if small == "None" else [0.0, 1.0])
    later = apply_one_hot_vectors(spark.createDataFrame([(1, "new", None)], "k long, wide string, small string"), fitted).first()
    assert later.wide_vector.numNonzeros() == later.small_vector.numNonzeros() == 0
    none = apply_one_hot_vectors(df.where("wide is null").select("wide"), fit_one_hot_vectors(df.where("wide is null").select("wide")))
    assert {r.wide_vector.numNonzeros() for r in none.collect()} == {0}
