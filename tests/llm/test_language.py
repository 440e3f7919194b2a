import random
import zlib

from cadence.llm import language as L
from cadence.llm.common import crc_mod


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out, model = L.identify(docs, crc_mod("doc_id", 4) == 2)
    truth = {r.doc_id: r for r in docs.select("doc_id", "lang", "text").collect()}
    rows = out.collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held)
    assert right / len(held) > 0.95, right / len(held)
    assert set(model.families) == {"germanic", "romance"}
    for r in rows[:50]:
        assert model.predict(truth[r.doc_id].text)[0] == r.lang_pred


def test_edge_cases(spark):
    rows = [(1, "the house and the garden", "en"), (2, "das Haus und der Garten", "de"), (3, "la maison et le jardin", "fr"),
            (4, None, "en"), (5, "", None), (6, "123 ...", "fr"), (7, "the garden", None), (None, "und der", "de"),
            (1, "the house and the garden", "en"), (9, "tlhIngan Hol", "tlh"), (10, "the " * 50000, None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    out, model = L.identify(docs, L.F.lit(False))
    got = [(r.doc_id, r.lang_pred) for r in out.collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert (by[4], by[5], by[6], by[7], by[10]) == ("und", "und", "und", "en", "en")
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"], "tlh": ["tlh"]}
    alone, _ = L.identify(docs.filter("lang = 'en'"), L.F.lit(False))
    assert {(r.lang_pred, r.score) for r in alone.filter("doc_id = 1").collect()} == {("en", 1.0)}
    none, _ = L.identify(docs.limit(0), L.F.lit(False))
    assert none.count() == 0
    unlabelled, _ = L.identify(docs.filter("lang is null"), L.F.lit(False))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_any_number_of_languages(spark):
    """120 languages with words of their own, noisy tags and 60 tags of one row each."""
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 6)))
    rows = []
    for k in range(120):
        words = [word(rng.sample("abcdefghijklmnopqrstuvwxyz", 9)) for _ in range(40)]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(40)), f"x{k:03}") for i in range(10)]
    rows += [(len(rows) + i, "the house and the garden of the old town " * 3, t) for i, t in enumerate(["en-US", "EN", "en"] * 5)]
    rows += [(len(rows) + i, " ".join(word("qwxz") for _ in range(30)), f"typo-{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out, model = L.identify(docs, L.F.col("doc_id") % 10 == 3)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if r[0] % 10 == 3 and r[2].startswith("x")]
    assert sum(got[d].lang_pred == lang for d, _, lang in held) / len(held) > 0.95
    assert {got[d].lang_pred for d, _, lang in rows if lang[:2].lower() == "en"} <= {"en-US", "EN", "en"}
    assert model.families["germanic"] == ["EN", "en", "en-US"]
    assert max(map(len, model.nodes)) <= L.FAN
    assert sorted(c for n in model.nodes for c in n if isinstance(c, str)) == sorted({r[2] for r in rows if r[0] % 10 != 3})


def test_letters_are_unicode_letters(spark):
    rows = [(1, "the house and the garden", "en"), (2, "das Haus und der Garten", "de")]
    rows += [(10 + i, t, None) for i, t in enumerate(["½", "²", "Ⅷ 12", "٣", "_", "①", "ª", "é", "字"])]
    out, _ = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), L.F.lit(False))
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert all(got[10 + i] == ("und", 0.0) for i in range(6))
    assert all(got[10 + i][0] in ("en", "de") for i in range(6, 9))


def test_language_of_repeated_rows_is_learned(spark):
    rng = random.Random(5)
    words = "the of and to in house garden town is was for that with on as old".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(20)), "en") for i in range(3000)]
    rows = [r for r in rows if r[0] != 7] + [(7, "das Haus und der Garten in der alten Stadt", "de")] * 5000
    out, _ = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), L.F.lit(False))
    assert out.filter("doc_id = 7 and lang_pred = 'de'").count() == 5000


def test_prediction_matches_plain_version(spark):
    """One text after the other, with dense vectors and the machines of each node as they were written."""
    import numpy as np
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out, model = L.identify(docs, L.F.lit(False))
    truth = {r.doc_id: r.text for r in docs.collect()}
    machines = {(r.node, r.pair): np.frombuffer(r.weights, np.float32) for r in spark.read.parquet(model.folder).collect()}

    def plain(text):
        if not any(c.isalpha() for c in text):
            return "und"
        body, dense = " " + L.re.sub(r"[\W\d_]+", " ", text.lower()) + " ", np.zeros(L.WIDTH + 1)
        data = body.encode()
        for i in range(len(data) - 2):
            code = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
            dense[(code * 2_654_435_761 % 2**32) >> 19] += 1
        dense = np.sqrt(dense / dense.sum())
        dense[-1] = 1
        node = 0
        while True:
            children = model.nodes[node]
            votes, sums, pair = [0] * len(children), [0.0] * len(children), 0
            for a in range(len(children)):
                for b in range(a + 1, len(children)):
                    margin = float(dense @ machines[node, pair])
                    votes[a if margin >= 0 else b] += 1
                    sums[a], sums[b], pair = sums[a] + margin, sums[b] - margin, pair + 1
            node = children[max(range(len(children)), key=lambda k: (votes[k], sums[k]))]
            if isinstance(node, str):
                return node

    for r in out.collect():
        assert r.lang_pred == (plain(truth[r.doc_id]) if truth[r.doc_id] else "und")
