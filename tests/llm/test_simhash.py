import random
import re

import numpy as np
import xxhash

from cadence.llm import simhash as S
from cadence.llm.components import connected_components


def brute_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, radius=4):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, x in zip(ids, prints):
        for b, y in zip(ids, prints):
            if a < b and (x ^ y).bit_count() <= radius:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def test_forest_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    value = np.unique(base[rng.integers(0, 6, 400)] ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64))
                      ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)))
    run = np.sort(rng.integers(0, 3, len(value)))
    q, n = S.Forest(run, value).within(run, value, 4)
    want = {(i, j) for i in range(len(value)) for j in range(len(value))
            if run[i] == run[j] and int(value[i] ^ value[j]).bit_count() <= 4}
    assert set(zip(q.tolist(), n.tolist())) == want


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(900, None), (901, ""), (902, " \t"), (903, "Two WORDS"), (904, "two words"), (905, "É x"), (906, "é x")]
    rows += [(1000 + i, rows[3][1] + " tail" * (i % 5)) for i in range(40)]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, bits string").repartition(6)
    got = {r.doc_id: r for r in S.simhash_components(df).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert {i: got[i].fingerprint for i, _ in rows} == {i: f"{p:016x}" for (i, _), p in zip(rows, prints)}
    assert {i: got[i].component_id for i, _ in rows} == brute_components([i for i, _ in rows], prints)


def test_large_shards_are_split(spark, monkeypatch):
    rng = random.Random(2)
    bits = sorted({0xABCDEF0123456789 ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(300)})
    monkeypatch.setattr(S, "TREE", 16)
    df = spark.createDataFrame([(i, b - (1 << 64) if b >> 63 else b) for i, b in enumerate(bits)], "id long, bits long")
    got = {r.node: r.component for r in connected_components(S.links(df)).collect()}
    want = brute_components(list(range(len(bits))), bits)
    assert {i: got.get(i, i) for i in want} == want


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (None, "q r s t u v")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in S.simhash_components(df).collect()), key=str)
    assert got == [(3, 3), (3, 3), (None, 3), (None, None)]
    assert S.simhash_components(df.limit(0)).count() == 0


def test_long_chain(spark):
    n = 300
    e = spark.range(n - 1).selectExpr("id as a", "id + 1 as b")
    assert {(r.node, r.component) for r in connected_components(e).collect()} == {(i, 0) for i in range(n)}


def test_different_texts_under_one_id(spark):
    a, b = "one two three four five six seven", "wholly other words stand in this text here"
    df = spark.createDataFrame([(7, a), (7, b), (8, a), (9, b), (5, b)], "doc_id long, text string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in S.simhash_components(df).collect()}
    pa, pb = (f"{brute_print(t):016x}" for t in (a, b))
    assert pa != pb and got == {(7, pa): 7, (8, pa): 7, (7, pb): 5, (9, pb): 5, (5, pb): 5}
