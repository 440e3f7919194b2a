import collections

import corpus_pipeline as C
from cadence.llm import decontaminate as D
from cadence.llm import packing as P
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_simhash import brute_components, brute_print


def _stages(spark, docs, sf_dir):
    out, at = [], docs
    for _, stage in C.STAGES:
        at = stage(spark, at, sf_dir)
        at = spark.createDataFrame(at.collect(), at.schema)
        out.append(at)
    return out


def test_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [tuple(r) for r in docs.collect()]
    extra = [(1000, None, "en", "s", 0), (1001, "123 !!", "de", "s", 6), (1002, rows[5][1], "en", "s", 1),
             (1003, rows[6][1] + " " + bench[0] + " more", rows[6][2], "s", 2), (1004, "", None, None, None)]
    df = spark.createDataFrame(rows + extra, docs.schema).repartition(4)
    told, single, clean, plain, packed = _stages(spark, df, sf)
    assert [d.columns for d in (told, single, clean, plain)] == [docs.columns] * 4
    # Language: everything with a letter stays here.
    want = {r[0]: r for r in rows + extra if r[1] and any(c.isalpha() for c in r[1])}
    assert {r.doc_id: tuple(r) for r in told.collect()} == want
    # Near duplicates: the smallest id of every component.
    ids = sorted(want)
    component = brute_components(ids, [brute_print(want[i][1]) for i in ids])
    want = {i: want[i] for i in ids if component[i] == i}
    assert {r.doc_id: tuple(r) for r in single.collect()} == want
    # Benchmark copies: whole items, as words, must be gone; nothing else goes.
    holds = lambda t: any(f" {' '.join(D.words(b))} " in f" {' '.join(D.words(t))} " for b in bench)
    got = {r.doc_id: tuple(r) for r in clean.collect()}
    assert got == {i: r for i, r in want.items() if not holds(r[1])} and 1003 not in got
    # Personal data: no base span is left, texts without any stay.
    after = {r.doc_id: tuple(r) for r in plain.collect()}
    assert set(after) == set(got)
    for i, r in after.items():
        spans = brute_spans(got[i][1])
        assert (r == got[i]) if not spans else not brute_spans(r[1]) and r[4] == len(r[1])
    # Packing: every token of every document, once.
    w = P.WordIds.get(P.tokenizer_path())
    length = collections.Counter()
    for r in packed.collect():
        length[r.doc_id] += r.length
    assert length == {i: len(w.whole.encode(r[1], add_special_tokens=False).ids) + 1 for i, r in after.items()}


def test_run_equals_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    out = _stages(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)[-1]
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(C.run(spark, sf)) == key(out)


def test_edges(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = docs.filter("doc_id = 3").first().text, docs.filter("doc_id = 4").first().text
    rows = [(None, a, "en", None, 9, 1), (None, a, "en", None, 9, 1), (7, b, "en", "s", None, 2), (7, b, "en", "s", None, 2), (8, None, None, None, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    told, single, clean, plain, packed = _stages(spark, df, sf)
    assert told.count() == 4 and sorted((r.doc_id or 0) for r in single.collect()) == [0, 7]
    assert clean.columns == df.columns and {r.score for r in plain.collect()} == {1, 2}
    empty = _stages(spark, df.limit(0), sf)
    assert [d.count() for d in empty] == [0] * 5


def test_different_texts_under_one_id(spark):
    sf = "/root/testdata/sf0.001"
    t = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id in (3, 4, 5)").orderBy("doc_id").collect()]
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    rows = [(7, t[0], "en"), (7, t[1], "en"), (7, t[1], "en"), (9, t[1], "en"), (8, t[2], "de"), (8, f"{t[0]} {t[1]} {bench}", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    _, single, clean, _, _ = _stages(spark, df, sf)
    assert sorted((r.doc_id, r.text) for r in single.collect()) == sorted({r[:2] for r in rows if r[0] != 9})
    assert sorted((r.doc_id, r.text) for r in clean.collect()) == sorted({r[:2] for r in rows[:2] + rows[4:5]})
