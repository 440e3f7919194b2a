import hashlib
import random

import numpy as np

from cadence.llm import blocks as B
from cadence.llm import suffixes as X


def brute(rows, n=50):
    least = {}
    top = 2**63 - 1
    data = [(top if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - n + 1):
            s = b[i:i + n]
            least[s] = min(least.get(s, top), d)
    out = []
    for (d, b), (raw, _) in zip(data, rows):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if least[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((raw, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def made(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "naïve", "and", "zebra", "x", "tion", "er"])
    rows = []
    for d in range(n):
        t = " ".join(word() for _ in range(rng.randint(0, 60)))
        if rows and rng.random() < 0.6:
            src = rng.choice(rows)[1] or ""
            a = rng.randint(0, len(src))
            t = t[:20] + src[a:a + rng.randint(30, 200)] + t[20:]
        rows.append((rng.choice([d, d * 7 % n]), t))
    rows += [(5, "ab" * 200), (900, "ab" * 100), (901, "a" * 49), (902, "a" * 300), (903, "a" * 51), (904, None), (905, ""),
             (906, rows[0][1]), (None, "ab" * 40), (907, "q" * 50), (3, "q" * 50 + "é" * 60), (908, "é" * 200)]
    return rows


def test_against_brute_force(spark, monkeypatch):
    for seed, piece, block in ((1, 1 << 18, 8 << 20), (2, 300, 2000)):
        monkeypatch.setattr(X, "PIECE", piece)
        monkeypatch.setattr(B, "BLOCK_BYTES", block)
        rows = made(seed)
        df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, kept binary").repartition(3)
        assert got(X.remove_repeats(df)) == brute(rows)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(X.op9_suffix_dedup(spark, "/root/testdata/sf0.001")) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_kept_bytes(spark):
    docs = spark.createDataFrame([(1, "x" * 10 + "passage " * 8), (2, "intro é " + "passage " * 8 + "end")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept) for r in X.remove_repeats(docs).collect()} == {
        1: b"x" * 10 + b"passage " * 8, 2: "intro é".encode() + b"end"}
    assert got(X.remove_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert X.remove_repeats(docs.limit(0)).count() == 0


def test_family_levels():
    rng = np.random.default_rng(1)
    f, seen = X.Family(), []
    for _ in range(40):
        b = (rng.integers(0, 50, 30).astype(np.uint64), rng.integers(0, 4, 30).astype(np.uint64), rng.integers(0, 99, 30))
        f.add(*b)
        seen.append(b)
        sizes = [len(x[0]) for x in f.levels]
        assert all(a > 2 * c for a, c in zip(sizes, sizes[1:]))
    f.settle()
    k, c, d = map(np.concatenate, zip(*seen))
    at = f.find(k, c)
    assert (f.levels[0][0][at] == k).all() and (f.levels[0][1][at] == c).all()
    assert all(x == d[(k == a) & (c == b)].min() for a, b, x in zip(k, c, f.levels[0][2][at]))
