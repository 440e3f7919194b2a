from pyspark.sql import functions as F

from cadence.operators.split import hash_split, split_sizes, train_val_split


def test_reference_split_sizes():
    assert split_sizes(768, 0.15, 0.15) == (536, 116, 116)


def test_exact_split_sizes_disjoint_complete(spark):
    df = spark.range(768).withColumnRenamed("id", "k")
    s = hash_split(df, "k", 0.15, 0.15, exact=True)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 536, "val": 116, "test": 116}
    assert s.select("k").distinct().count() == 768


def test_split_stable_under_repartition(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {(r["k"], r["split"]) for r in hash_split(df, "k").collect()}
    b = {(r["k"], r["split"]) for r in hash_split(df.repartition(7), "k").collect()}
    assert a == b


def test_exact_split_many_buckets_boundary(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    s = hash_split(df, "k", 0.2, 0.1, exact=True)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"test": 4000, "val": 2000, "train": 14000}


def test_stratified(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    s = hash_split(df, "k", 0.2, 0.1, exact=True, stratify_by="y")
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c[(1, "test")] == 67 and c[(0, "test")] == 134


def test_train_val_floor(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    c = {r["split"]: r["count"] for r in train_val_split(df, "k", 0.2, exact=True).groupBy("split").count().collect()}
    assert c == {"val": 20, "train": 81}


def test_exact_split_with_hot_key(spark):
    # a third of the rows share one key: its bucket is large and may sit on a cut
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("payload"))
    for t, v in ((0.15, 0.15), (0.5, 0.2), (0.3, 0.05)):
        s = hash_split(df, "k", t, v, exact=True)
        got = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
        assert got["test"] == int(__import__("math").ceil(3000 * t)) and sum(got.values()) == 3000
        assert s.select("payload").distinct().count() == 3000


def test_exact_split_of_a_million_rows_on_one_hot_key(spark):
    """Payload columns, a third of the rows equal in all columns, the rest on one key: exact sizes, and
    the same labels twice."""
    n = 1_000_000
    df = spark.range(n).selectExpr("'hot' as k", "case when id % 3 = 0 then 0 else id end as payload", "cast(id % 3 = 0 as int) as same")
    labels = []
    for _ in range(2):
        out = hash_split(df, "k", 0.2, 0.1, exact=True)
        got = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
        assert (got["train"], got["val"], got["test"]) == split_sizes(n, 0.2, 0.1)
        labels.append(out.groupBy("split", "same").agg(F.count("*").alias("c"), F.sum(F.xxhash64("payload").cast("decimal(38,0)")).alias("h"))
                      .orderBy("split", "same").collect())
    assert labels[0] == labels[1]


def test_global_rank_of_a_million_rows(spark):
    from cadence.functions.ranking import global_rank
    df = spark.range(1_000_000).selectExpr("case when id % 3 = 0 then -1 else id * 7919 % 1000003 end as v", "uuid() as payload", "id")
    r = global_rank(df, ["v"]).agg(F.count_distinct("rank"), F.min("rank"), F.max("rank"),
                                   F.max(F.when(F.col("v") == -1, F.col("rank")))).first()
    assert tuple(r) == (1_000_000, 0, 999_999, 333_333)


def test_many_strata(spark):
    df = spark.range(6000).selectExpr("id", "id % 2000 as s")
    out = hash_split(df, "id", 0.34, 0.33, exact=True, stratify_by="s").groupBy("s", "split").count()
    assert {(r["split"], r["count"]) for r in out.collect()} == {("test", 2), ("val", 1)}
