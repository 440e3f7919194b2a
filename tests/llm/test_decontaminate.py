import random

import numpy as np

from cadence.llm import decontaminate as D


def brute_score(a, b):
    """Smith-Waterman with linear gaps, cell by cell, over that of an exact copy."""
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max() / (2 * len(a)) if a else 0.0


def _vocab(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def test_alignment_against_cells():
    rng = random.Random(1)
    for _ in range(60):
        item = [rng.randint(1, 6) for _ in range(rng.randint(1, 12))]
        rows = [[rng.randint(0, 6) for _ in range(20)] for _ in range(5)]
        best, _ = D.smith_waterman(np.array(item), np.array(rows))
        assert [b / (2 * len(item)) for b in best] == [brute_score(item, [x or -1 for x in r]) for r in rows]


def test_planted_copies(spark):
    rng = random.Random(5)
    vocab = _vocab(rng, 400)
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [text(rng.randint(20, 40)) for _ in range(30)] + [["two", "words"]]
    docs, planted = [], {}
    for d in range(200):
        w = text(rng.randint(50, 400))
        if d % 4 == 0:
            i = 0 if d % 8 == 0 else rng.randrange(len(items) - 1)  # item 0 is everywhere
            copy = list(items[i])
            for _ in range(len(copy) // 8 if d % 3 else 0):  # edited: replaced, dropped, inserted words
                k = rng.randrange(len(copy))
                copy[k:k + 1] = rng.choice([[rng.choice(vocab)], [], [copy[k], rng.choice(vocab)]])
            at = rng.randrange(len(w))
            w[at:at] = copy
            planted[d] = i
        docs.append((d, (", " if d % 5 else " ").join(w).upper() if d % 7 == 0 else " ".join(w), 1.0))
    bench = spark.createDataFrame([(i, " ".join(w).title() + ".") for i, w in enumerate(items)] + [(99, " ".join(items[3]))],
                                  "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string, score double").repartition(5)
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(df, bench).collect()}
    assert {(d, i) for d, i in planted.items()} <= set(got)
    for d, t, _ in docs:
        for i, w in enumerate(items[:-1]):
            s = brute_score(w, D.words(t)) if d < 60 or (d, i) in got else 0
            if s >= 0.55:
                assert abs(got[d, i].score - s) < 1e-9, (d, i, s)
            if (d, i) in got:
                r = got[d, i]
                assert abs(brute_score(w, D.words(t)[r.start_word:r.end_word]) - r.score) < 1e-9


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(tuple, D.contaminated(docs, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 500)
    assert sorted(map(tuple, D.contaminated(docs, bench).collect())) == one and one
    held = {(r.doc_id, b.item_id) for b in bench.collect() for r in docs.collect()
            if f" {' '.join(D.words(b.text))} " in f" {' '.join(D.words(r.text))} "}
    assert held <= {(d, i) for d, i, *_ in one}


def test_edges(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, None), (3, ""), (4, "solo"), (None, "zeta eta theta iota")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x alpha beta gamma delta epsilon y"), (4, "solo"), (4, "solo"),
                                  (5, "zeta eta theta iota"), (6, "nothing here " * 20000)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.score, r.start_word, r.end_word) for r in D.contaminated(docs, bench).collect()), key=str)
    assert got == sorted([(None, 1, 1.0, 1, 6), (4, 4, 1.0, 0, 1), (4, 4, 1.0, 0, 1), (5, None, 1.0, 0, 4)], key=str)
    assert D.contaminated(docs.limit(0), bench).count() == 0 and D.contaminated(docs, bench.limit(0)).count() == 0


def test_every_alignment_over_the_score(spark):
    """Edits that leave few or no 3-grams, parts of items, and a large group of equal edited copies,
    against cell-by-cell alignment of all (document, item) pairs."""
    rng = random.Random(11)
    vocab, other = _vocab(rng, 3000), ["the", "of", "and"]
    items = [[rng.choice(vocab) for _ in range(n)] for n in (38, 38, 59, 16, 38, 24)] + [["a", "b"] * 6, ["two", "words"]]
    edits = {"every 5th": lambda w: [rng.choice(vocab) if k % 5 == 4 else x for k, x in enumerate(w)],
             "every 4th": lambda w: [rng.choice(vocab) if k % 4 == 3 else x for k, x in enumerate(w)],
             "every 3rd": lambda w: [rng.choice(vocab) if k % 3 == 2 else x for k, x in enumerate(w)],
             "first half": lambda w: w[:len(w) // 2 + 1],
             "last half": lambda w: w[-(len(w) // 2 + 1):],
             "inserted": lambda w: [y for x in w for y in (x, rng.choice(other))][:-1],
             "inserted in the first half": lambda w: [y for k, x in enumerate(w) for y in ([x, *other] if k < 10 and k % 2 else [x])]}
    docs = []
    for edit in edits.values():
        for w in items:
            body = [rng.choice(vocab + other * 300) for _ in range(rng.randint(30, 150))]
            at = rng.randrange(len(body))
            docs.append(body[:at] + edit(w) + body[at:])
    same = edits["every 5th"](items[0])
    docs += [[rng.choice(vocab) for _ in range(20)] + same for _ in range(300)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(df, bench).collect()}
    want = {}
    for d, w in enumerate(docs):
        for i, x in enumerate(items):
            # Below half of the words in common no alignment reaches the score.
            s = brute_score(x, w) if 2 * sum(y in set(w) for y in x) >= len(x) else 0
            enough = s * len(x) >= D.MIN_MATCHED if len(x) >= D.MIN_MATCHED else w == x
            if s >= D.MIN_SCORE and enough:
                want[d, i] = s
    assert got == want
    assert {(d, 0) for d in range(len(docs) - 300, len(docs))} <= set(got)
    planted = {(k * len(items) + i, i) for k, name in enumerate(edits) for i, w in enumerate(items) if brute_score(w, edits[name](w)) >= 0.5 and len(w) > 4}
    assert len(planted) > 40 and planted <= set(got)


def test_short_items_do_not_flag_common_words(spark):
    bench = spark.createDataFrame([(1, "what is"), (2, "the"), (3, "is it on or off"), (4, "one two three four five six seven")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "the cat is what is on the mat"), (2, "What is?"), (3, "the"), (4, "the the"),
                                  (5, "so is it on or off now"), (6, "is it on or gone"), (7, "one two three four five"), (8, "one two three four")],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.item_id, round(r.score, 3)) for r in D.contaminated(docs, bench).collect()}
    assert got == {(2, 1, 1.0), (3, 2, 1.0), (5, 3, 1.0), (7, 4, 0.714)}


def test_very_long_items(spark):
    """Items of 10,000 words, one of 3,000,000 characters: a copy with edits, and a half that just reaches the score."""
    rng = random.Random(8)
    vocab = _vocab(rng, 20_000)
    item = [rng.choice(vocab) for _ in range(10_000)]
    edited = [w for k, w in enumerate(item) if k % 50]
    docs = [(1, " ".join(["before", *edited, "behind"])), (2, " ".join(item[:5_200])), (3, " ".join(item[:4_000])), (4, " ".join(vocab[:3_000]))]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "x" * 3_000_000 + " y z")], "item_id long, text string")
    got = {r.doc_id: r for r in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert set(got) == {1, 2}
    assert got[2].score == 0.52 and (got[2].start_word, got[2].end_word) == (0, 5_200)
    assert abs(got[1].score - (2 * 9_800 - 199) / 20_000) < 1e-3


def test_batches_are_numbered_as_their_words(monkeypatch):
    """Texts of a batch together give the same numbers as words one by one, in any script; only words
    with odd characters, very long ones and texts with a capital sigma are looked at one by one."""
    import pyarrow as pa
    rng = random.Random(4)
    plain = ["a", "Bc", "z_9", "abcdefgh", "ABCDEFGHI", "sixteen_letters_", "x" * 40, "É", "ß", "señor", "Жук", "中文", " ", "\n", "\0", "-", "·", "\xa0", "—", "’"]
    odd = ["İ", "K", "ẞ", "Ⱥ", "ΟΔΟΣ", "Σ", "😀", "𐐀", "̇", "σ", "Y" * 64, "y" * 65, "Жу" * 40, "y" * 200]

    def text(parts, between=""):
        return between.join(rng.choice(parts) for _ in range(rng.randint(0, 60)))

    items = D.Items([(i, text(plain + odd if i % 2 else plain)) for i in range(40)])
    for parts, between in ((plain, " "), (plain, ""), (plain + odd, "")):
        docs = [text(parts, between) if i % 5 else "" for i in range(300)]
        want = [[items.vocabulary.get(w, 0) for w in D.words(t)] for t in docs]
        with monkeypatch.context() as m:
            if between:
                m.setattr(D, "words", None)
            for column in (pa.array(docs), pa.array(["é", *docs], pa.large_string()).slice(1)):
                numbers, sizes = items.numbers(column)
                assert sizes.tolist() == [len(w) for w in want]
                assert numbers.tolist() == [n for w in want for n in w]
    assert items.numbers(pa.array([], pa.string()))[0].tolist() == []
    assert len(D.Items([(1, "y" * 3_000_000)]).levels) == 0   # not cut into 375,000 pieces


def test_places_of_a_batch_in_parts(monkeypatch):
    """Seeds with many places are looked at in bounded parts: the same passages come out."""
    import pyarrow as pa
    rng = random.Random(6)
    vocab = _vocab(rng, 12)
    items = D.Items([(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(6, 20)))) for i in range(20)])
    items.choose_seeds(np.ones(len(items.vocabulary) + 1, np.int64), D.MIN_SCORE)
    docs = items.numbers(pa.array([" ".join(rng.choice(vocab) for _ in range(rng.choice((0, 1, 2, 3, 50)))) for _ in range(40)]))
    want = set()
    first = np.cumsum(docs[1]) - docs[1]
    for d, (b, n) in enumerate(zip(first.tolist(), docs[1].tolist())):
        alone = D.suggest(items, docs[0][b:b + n], docs[1][d:d + 1])
        want |= {(d, i, q) for i, q in zip(alone[1].tolist(), alone[2].tolist())}
    for at_once in (D.HITS_AT_ONCE, 7, 1):
        monkeypatch.setattr(D, "HITS_AT_ONCE", at_once)
        got = list(zip(*(x.tolist() for x in D.suggest(items, *docs))))
        assert len(got) == len(want) and set(got) == want
