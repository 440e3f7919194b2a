import base64
import math
import random
import re
import unicodedata
from collections import Counter

import pytest

from cadence.llm import fertility as T

P = pytest.importorskip("public_tokenizers")
PATHS = (P.path("piece_bpe_32k.model"), P.path("byte_bpe_multi_50k.tiktoken"))


def plain(text):
    """One document, one word at a time, without any cache."""
    import sentencepiece
    import tiktoken
    if not hasattr(plain, "models"):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATHS[1], "rb"))}
        plain.models = (sentencepiece.SentencePieceProcessor(model_file=PATHS[0]),
                        tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    pieces, byte_level = plain.models
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    tokens = [pieces.id_to_piece(i) for w in words for i in pieces.encode(w)]
    chars, n = sum(map(len, words)), len(tokens)
    scripts = Counter()
    for w in words:
        names = [unicodedata.name(c, "").split(" ")[0] for c in w if c.isalpha()]
        scripts.update([x for x in names if x][:1])
    return {"n_words": len(words), "word_chars": chars, "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_tokens": n,
            "script": min(scripts, key=lambda s: (-scripts[s], s), default=""),
            "chars_per_token": chars / n if n else 0, "chars_per_byte_token": chars / m if (m := sum(len(byte_level.encode_ordinary(w)) for w in words)) else 0,
            "fallback_share": sum(t.startswith("<0x") for t in tokens) / n if n else 0,
            "token_entropy": -sum(c / n * math.log2(c / n) for c in Counter(tokens).values()) if n else 0}


def texts(rng):
    words = ["the", "cat", "sat", "on", "a", "mat.", "é", "дом", "мир", "日本語", "#x|", "<b>", "\x1c", " ", "😀", "ﬁ", "z" * 300]
    out = [None, "", " \t\r\n", "one", "one two three", "a b c a b c", "x\n\nx \nx\n y\ny", "1 2 3 4"]
    out += ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\x0b"]) for _ in range(rng.randrange(200))) for _ in range(60)]
    return [*out, "long words here " * 30_000, "w" * 200_000]


def test_measures_match_plain_version(spark, monkeypatch):
    monkeypatch.setattr(T, "CACHE", 5)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts(random.Random(1)))] + [(3, "one"), (3, "one")]
    frame = spark.createDataFrame([(i, t, "xx", 1, "s") for i, t in rows], "doc_id long, text string, lang string, n_words int, script string")
    got = T.measure(frame.coalesce(1), *PATHS).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    for r, (_, t) in zip(got, rows):
        for k, v in plain(t).items():
            assert r[k] == (pytest.approx(v, abs=1e-9) if isinstance(v, float) else v), (k, t and t[:50])


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def fences(values):
    """Of grid values, as the operator's docstring has them."""
    v = sorted(math.floor(x * T.GRID + 0.5) / T.GRID for x in values)
    return tuple(v[max(math.ceil(p * len(v)) - 1, 0)] for p in (0.25, 0.75))


def test_bands_reject_junk_and_keep_prose(spark):
    rng = random.Random(2)
    english = ["".join(rng.choice(["ten", "ing", "the", "re", "an", "lo", "mi", "st", "or"]) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    russian = ["".join(rng.choice(["но", "то", "пра", "ет", "ли", "во"]) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rows = [(i, prose(rng, rng.randrange(60, 400), english), "en") for i in range(300)]
    rows += [(1000 + i, prose(rng, rng.randrange(60, 400), russian), rng.choice(["ru", None])) for i in range(140)]
    rows += [(2000, " ".join("%08x" % rng.randrange(1 << 32) for _ in range(120)), "en"),      # hashes
             (2001, prose(rng, 200, ["THE$$$", "ING%%%", "RE&&&", *[w.upper() + "!!" for w in english]]), "en"),
             (2002, " ".join("😀🦊"[i % 2] * rng.randrange(1, 9) + chr(0x1F600 + i % 70) for i in range(90)) + " ten", "en"),  # byte fallback
             (2003, prose(rng, 49, english), "en"), (2004, "the same line " * 40, "en"), (2005, None, "en"),
             (2006, prose(rng, 300, russian), "en"), (2007, prose(rng, 300, ["".join(rng.choice("日本語学生大小") for _ in range(4)) for _ in range(90)]), "ja")]
    out = {r.doc_id: r for r in T.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), *PATHS).collect()}
    assert len(out) == len(rows)
    good = [out[i].kept for i, _, _ in rows if i < 2000]
    assert sum(good) >= 0.995 * len(good)
    assert not any(out[i].kept for i in (2000, 2001, 2002, 2003, 2004, 2005))
    assert all(out[i].base_failed for i in (2003, 2004, 2005)) and not any(out[i].base_failed for i in (2000, 2001, 2002))
    assert "fallback_share" in out[2002].outside
    # A language of one document goes by its script, a script of one document by none.
    assert (out[2006].band, out[2007].band, out[2007].kept) == ("script", None, True)
    passing = [r for r in out.values() if not r.base_failed and (r.script, r.lang) == ("LATIN", "en")]
    table = T.bands(spark.createDataFrame([(r.script, r.lang, *[r[m] for m in T.MEASURES]) for r in passing],
                                          "script string, lang string, " + ", ".join(f"{m} double" for m in T.MEASURES)), ("script", "lang")).collect()
    assert len(table) == 1
    for m in T.MEASURES:
        q1, q3 = fences([r[m] for r in passing])
        reach = T.FENCE * max(q3 - q1, T.LEAST_SPREAD[m])
        assert (table[0][f"low_{m}"], table[0][f"high_{m}"]) == (pytest.approx(q1 - reach), pytest.approx(q3 + reach))


def test_empty_table(spark):
    assert T.quality_rules(spark.createDataFrame([], "doc_id long, text string, lang string"), *PATHS).count() == 0
