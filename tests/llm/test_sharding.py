import zlib

from cadence.llm import sharding as S


def test_permutation_and_inverse():
    for n in (1, 2, 3, 7, 24, 100, 1009):
        places = [S.row_to_place(i, n, 5) for i in range(n)]
        assert sorted(places) == list(range(n))
        assert [S.place_to_row(p, n, 5) for p in places] == list(range(n))


def test_spark_equals_plain(spark):
    n = 1500
    got = spark.range(n).select("id", S.feistel_place(S.F.col("id"), n, 42).alias("p")).collect()
    assert {r.id: r.p for r in got} == {i: S.row_to_place(i, n, 42) for i in range(n)}


def test_documents(spark):
    rows = [(i, f"text {i} é") for i in range(200)] + [(None, None), (500, None), (501, ""), (7, "text 7 é")]
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, shard int, slot int")
    out = S.shard_documents(docs.repartition(7), 24).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        if r.doc_id is not None and r.doc_id < 200:
            t = f"text {r.doc_id} é".encode()
            assert (r["size"], r.text_crc32) == (len(t) + 8, zlib.crc32(t))
        place = r.slot * 24 + r.shard
        assert S.row_to_place(r.row_number, len(rows), 42) == place
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    again = {(r.doc_id, r.row_number, r.shard) for r in S.shard_documents(docs.repartition(2), 24).collect()}
    assert {(r.doc_id, r.row_number, r.shard) for r in out} == again


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.shard_documents(docs).count() == 0
