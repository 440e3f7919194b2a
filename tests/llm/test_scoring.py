import re
import zlib
from collections import Counter
from math import log10

import numpy as np

from cadence.llm import scoring as S
from cadence.llm.common import crc_mod


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows):
    """Scores by walking an explicit automaton (dictionaries) token by token."""
    uni, bi, docs = Counter(), Counter(), 0
    for d, text in rows:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1:
            seq = ["\n", *tokens(text), " "]
            uni.update(seq[1:])
            bi.update(zip(seq, seq[1:]))
            docs += 1
    n, v = sum(uni.values()), len(uni)
    followed = Counter(uni)
    followed["\n"] = docs
    del followed[" "]
    mass, square = np.zeros(64), np.zeros(64)
    for c in followed.values():
        mass[int(np.log2(c))] += c
        square[int(np.log2(c))] += c * c
    once = sum(c == 1 for c in bi.values())
    some = mass > 0
    k = S.solve_mass(mass[some], square[some] / mass[some], min(max(once / max(mass.sum(), 1), 1e-6), 1 - 1e-6))
    out = []
    for _, text in rows:
        state, base, score, known = "\n", 0.0, 0.0, 0
        seq = [*tokens(text), " "]
        for w in seq:
            p = (uni[w] + 0.5) / (n + 0.5 * (v + 1))
            c = followed[state]
            fail = k / (k + c ** 0.25) if c else 1.0
            score += log10((1 - fail) * bi[state, w] / c + fail * p) if bi[state, w] else log10(fail) + log10(p)
            base += log10(p)
            known += uni[w] > 0
            state = w
        out.append((len(seq), known, n, base, score))
    return out


def test_equals_the_walked_automaton(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, None), (1001, ""), (None, "The the THE"), (1003, "é É \x1c x"), (1004, "unseen_word"), (3, rows[3][1]), (3, rows[3][1]),
             (1005, "the " * 30000)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, block int").repartition(4)
    got = sorted(S.score_documents(df, crc_mod("doc_id", 5) == 1).collect(), key=str)
    want = sorted([(d, zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1, *x) for (d, _), x in zip(rows, brute(rows))], key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert abs(g.base_score - w[5]) <= 1e-9 * abs(w[5]) and abs(g.score - w[6]) <= 1e-9 * abs(w[6])


def test_blocks_do_not_matter_and_held_out_gains(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = {r.doc_id: r for r in S.op3_lm_scoring(spark, "/root/testdata/sf0.01").collect()}
    import cadence.llm.blocks as B
    monkeypatch.setattr(B, "BLOCK_BYTES", 1)
    small = S.score_documents(docs.limit(150), crc_mod("doc_id", 5) == 1).collect()
    assert len(small) == 150
    held = [r for r in one.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_and_nothing_to_learn(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.score_documents(df, S.F.lit(False)).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = S.score_documents(one, S.F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
