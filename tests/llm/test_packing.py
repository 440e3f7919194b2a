import random
import struct
import zlib

from cadence.llm import packing as P


def test_local_search_beats_or_equals_best_fit():
    rng = random.Random(3)
    for cap in (10, 100, 4096):
        sizes = [rng.randint(1, cap) for _ in range(600)]
        bins = P.best_fit_decreasing(sizes, cap)
        first = [list(b) for b in bins]
        better = P.local_search(sizes, bins, cap)
        assert sorted(i for b in better for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= cap for b in better)
        square = lambda bs: sum(sum(sizes[i] for i in b) ** 2 for b in bs)
        assert square(better) >= square(first) and len(better) <= len(first)
    sizes = [6, 4, 4, 3, 3]  # two-for-one: {6,4} {4,3,3}; start badly
    assert len(P.local_search(sizes, [[0, 3], [1, 2], [4]], 10)) == 2


def test_word_cache_equals_tokenizer():
    w = P.WordIds(P.tokenizer_path())
    samples = ["Hello, World. it's  IT'S\n12 3", "<|endoftext|> x<|startoftext|>y", "a\x1cb c", "ÉCOLE élan ΣΑΣ Σ. ß", "",
               "z​ w　x éa", "a" * 5000 + " …", "don't. a.b.c, x.,"] * 2
    for text, got in zip(samples, w.encode(samples)):
        ids = w.whole.encode(text, add_special_tokens=False).ids
        assert got == struct.pack(f"<{len(ids)}I", *ids)


def _check(rows, texts):
    w = P.WordIds.get(P.tokenizer_path())
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts:
        ids = [*w.whole.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(docs[doc_id], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        for p in pieces:
            part = ids[p.start:p.start + p.length]
            assert len(part) == p.length and p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        assert [p.length for p in pieces] == [4096] * ((len(ids) - 1) // 4096) + [(len(ids) - 1) % 4096 + 1]
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and {r.fill for r in s} == {at}
    return len(seqs)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "ab " * 9000)]
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, offset int").repartition(5)
    out = P.pack_documents(df, P.tokenizer_path()).collect()
    n = _check(out, rows)
    assert n <= -(-sum(r.length for r in out) // 4096) + 1


def test_empty(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string"), P.tokenizer_path()).count() == 0
