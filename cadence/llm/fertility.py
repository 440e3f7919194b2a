"""Quality rules by tokeniser fertility.

Public vocabularies were made for ordinary text, so text that they split unusually badly or well, or
into few different tokens, is seldom prose. For every text three things are measured on its words: characters
per token (in each of two vocabularies), the share of tokens that are single bytes because the vocabulary lacks a
character, and the entropy of the tokens in bits. A band of accepted values for each of them comes
from the documents themselves: per script, language and length (short texts vary more), the quartiles of all
documents that pass the base rules, widened on both sides by ``FENCE`` times their distance (at least
``LEAST_SPREAD``). A document outside a band is rejected.

One Arrow pass measures the texts; words are tokenized once and remembered, in a cache of bounded size. The
narrow measures are written once; the quartiles come from counts on a grid (0.001 of each
measure), so no values are collected, and no sample is taken. The bands are tables with a row for each group of
at least ``LEAST_DOCUMENTS`` documents, joined by Spark as their size asks for.

Nulls, ties and odd tables: a null text is empty; texts with fewer words than the base rules ask for, empty ones
too, are rejected by them and have measures of 0; a null language is a language of its own; documents of a
group with fewer documents than ``LEAST_DOCUMENTS`` go by the band of their language, or else of their script,
and those of a script with fewer than that are not held against any band; a text without a letter has the empty script; repeated rows and ids are
judged each. Values on the edge of a band are inside. An empty table gives no rows, extra columns are ignored, texts are read whole.
"""

from __future__ import annotations

import base64
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.ranking import join_null_safe
from cadence.llm.common import cut, query, read, shared_folder

MIN_WORDS = 50
REPEATED_PERCENT = 50
FENCE = 3.0
GRID = 1000                # steps of a measure's unit
LEAST_DOCUMENTS = 50
CACHE = 500_000            # words that a worker remembers
SYMBOLS = b"#*$%&|<>"
MEASURES = ("chars_per_token", "chars_per_byte_token", "fallback_share", "token_entropy")
LEAST_SPREAD = {"chars_per_token": 0.05, "chars_per_byte_token": 0.05, "fallback_share": 0.02, "token_entropy": 0.2}
#: Groups with a band of their own; where one is too small, the next one's band holds. Lengths are powers of two.
BANDS = (("script", "lang", "length"), ("script", "lang"), ("script",))
MEASURED = ("doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_tokens long, " + ", ".join(f"{m} double" for m in MEASURES))


class Words:
    """What is known of every word a worker has met: characters, tokens, byte tokens, script."""

    by_paths: dict = {}

    def __init__(self, pieces: str, ranks: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.bytes = tiktoken.Encoding("byte tokens", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.scripts, self.of_letter = [""], {}
        self._clear()

    def _clear(self):
        self.place: dict[bytes, int] = {}
        self.known = [np.zeros((0, 5), np.int64)]  # characters, tokens, byte-level tokens, byte fallbacks, script
        self.ids = [np.zeros(0, np.int32)]

    @classmethod
    def get(cls, paths: tuple[str, str]) -> Words:
        if paths not in cls.by_paths:
            cls.by_paths[paths] = cls(*paths)
        return cls.by_paths[paths]

    def script(self, word: str) -> int:
        """Number of the script of the first letter, told by its Unicode name; 0 without one."""
        for c in word:
            if c not in self.of_letter:
                name = unicodedata.name(c, "").split(" ")[0] if c.isalpha() else ""
                if name not in self.scripts:
                    self.scripts.append(name)
                self.of_letter[c] = self.scripts.index(name)
            if self.of_letter[c]:
                return self.of_letter[c]
        return 0

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place of every word, table by place, first token of every place, tokens)."""
        if len(self.place) > CACHE:
            self._clear()
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if new:
            text = [w.decode("utf-8", "replace") for w in new]
            ids = self.pieces.encode(text, num_threads=1)
            flat = np.fromiter((i for x in ids for i in x), np.int32)
            n = np.array([len(x) for x in ids])
            fallback = np.concatenate([[0], np.cumsum(self.is_byte[flat])])
            edge = np.concatenate([[0], np.cumsum(n)])
            self.known.append(np.array([[len(t) for t in text], n, [len(self.bytes.encode_ordinary(t)) for t in text],
                                        fallback[edge[1:]] - fallback[edge[:-1]], [self.script(t) for t in text]], np.int64).T)
            self.ids.append(flat)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.known, self.ids = [np.concatenate(self.known)], [np.concatenate(self.ids)]
        place = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return place, self.known[0], np.cumsum(self.known[0][:, 1]) - self.known[0][:, 1], self.ids[0]


def repeated_words(place: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Words of each document that stand in a window of three words found twice or more in it.
    ``place`` numbers the words of all documents, ``edge`` has the first word of each and the end."""
    n, docs = len(place), len(edge) - 1
    inside = np.zeros(n + 1, np.int64)
    if n >= 3:
        size = np.diff(edge)
        doc = np.repeat(np.arange(docs), size)
        whole = np.flatnonzero(doc[:-2] == doc[2:])
        key = place[whole]
        for more in (place[whole + 1], place[whole + 2], doc[whole]):  # dense numbers, so that keys never overflow
            _, key = np.unique(key, return_inverse=True)
            key = key * (int(more.max(initial=0)) + 1) + more
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        for at in range(3):
            inside[whole[count[back] > 1] + at] = 1
    total = np.concatenate([[0], np.cumsum(inside[:n])])
    return total[edge[1:]] - total[edge[:-1]]


def entropies(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Entropy in bits of each document's tokens."""
    key, count = np.unique(doc * (1 << 20) + ids, return_counts=True)
    of = key >> 20
    n = np.bincount(doc, minlength=docs).astype(float)
    inner = np.bincount(of, count * np.log2(count), docs)
    some = np.maximum(n, 1)
    return np.maximum(np.log2(some) - inner / some, 0.0)


def measure_batch(texts: list[bytes], words: Words) -> dict[str, np.ndarray | list]:
    """Measures of whole texts; the base counts are those of the contract."""
    docs = len(texts)
    split = [t.split() for t in texts]  # bytes: at space, \\t, \\n, \\v, \\f, \\r only
    edge = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    flat = [w for ws in split for w in ws]
    doc = np.repeat(np.arange(docs), np.diff(edge))
    place, known, first, ids = words.look_up(flat)
    add = lambda x: np.bincount(doc, x, docs).astype(np.int64)
    chars, tokens, byte_tokens, fallback, script = known[place].T
    total, n_chars = add(tokens), add(chars)
    at = np.repeat(first[place] - (np.cumsum(tokens) - tokens), tokens) + np.arange(int(tokens.sum()))
    lines = []
    for t in texts:
        some = [x for x in t.split(b"\n") if x.strip()]
        lines.append(len(some) - len(set(some)))
    # Words of each script; ties go to the script whose name comes first.
    names = sorted(range(len(words.scripts)), key=words.scripts.__getitem__)
    tally = np.zeros((docs, len(names)), np.int64)
    np.add.at(tally, (doc, script), 1)
    tally[:, 0] = 0
    best = np.asarray(names)[tally[:, names].argmax(1)]
    share = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    return {"script": [words.scripts[k] if tally[i, k] else "" for i, k in enumerate(best)],
            "n_words": np.diff(edge), "word_chars": n_chars, "n_symbols": [sum(t.count(c) for c in SYMBOLS) for t in texts],
            "n_dup_lines": lines, "n_repeat_words": repeated_words(place, edge), "n_tokens": total,
            "chars_per_token": share(n_chars, total), "chars_per_byte_token": share(n_chars, add(byte_tokens)),
            "fallback_share": share(add(fallback), total), "token_entropy": entropies(ids[at].astype(np.int64), np.repeat(doc, tokens), docs)}


def measure(docs: DataFrame, pieces: str, ranks: str) -> DataFrame:
    """(doc_id, lang, script, base counts, n_tokens, measures): one row per document. ``pieces`` is the path
    of a vocabulary with byte fallback, ``ranks`` that of a byte-level one; every worker has both."""
    def run(batches):
        words = Words.get((pieces, ranks))
        for b in batches:
            got = measure_batch([t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()], words)
            schema = MEASURED.split(", ")[2:]
            kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
            columns = [pa.array(got[n], kinds[t]) for n, t in (f.split(" ") for f in schema)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), *columns], names=[f.split(" ")[0] for f in MEASURED.split(", ")])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text"))
    return narrow.mapInArrow(run, MEASURED)


def bands(passing: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by..., low_x and high_x of every measure x): fences of the documents given, for every group of
    ``by`` with documents enough."""
    value = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * GRID).cast("long").alias("v")) for m in MEASURES]))
    counts = passing.select(*by, value.alias("m")).groupBy(*by, "m.measure", "m.v").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*by, "measure")
    upto = F.sum("c").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).withColumn("n", F.sum("c").over(w)).where(F.col("n") >= LEAST_DOCUMENTS)
    quartile = lambda p: F.min(F.when(F.col("upto") >= p * F.col("n"), F.col("v"))) / F.lit(float(GRID))
    least = F.create_map(*[F.lit(x) for m in MEASURES for x in (m, LEAST_SPREAD[m])])
    q = ranked.groupBy(*by, "measure").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), least[F.col("measure")])
    fences = q.select(*by, "measure", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    pick = lambda side, m: F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{side}_{m}")
    return fences.groupBy(*by).agg(*[pick(side, m) for m in MEASURES for side in ("low", "high")])


def quality_rules(docs: DataFrame, pieces: str, ranks: str) -> DataFrame:
    """The measures of `measure` with base_failed, band (the last column of the group whose band holds, or
    null), outside (the measures that lie out of it) and kept."""
    spark = docs.sparkSession
    judged = cut(measure(docs, pieces, ranks)).withColumn("length", F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int")).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")))
    passing, limits = judged.where("not base_failed"), [f"{side}_{m}" for m in MEASURES for side in ("low", "high")]
    for by in BANDS:
        path = shared_folder(spark, "bands")  # written, so that the planner knows its size when it joins
        bands(passing, by).write.parquet(path)
        table = spark.read.parquet(path).select(*by, *[F.col(c).alias(f"{by[-1]}_{c}") for c in limits])
        judged = join_null_safe(judged, table, list(by))
    edge = lambda side, m: F.coalesce(*[f"{by[-1]}_{side}_{m}" for by in BANDS])
    out = [F.when((F.col(m) < edge("low", m)) | (F.col(m) > edge("high", m)), m) for m in MEASURES]
    band = F.coalesce(*[F.when(F.col(f"{by[-1]}_{limits[0]}").isNotNull(), by[-1]) for by in BANDS])
    return (judged.withColumn("band", band).withColumn("outside", F.array_compact(F.array(*out)))
            .withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
            .drop("length", *[f"{by[-1]}_{c}" for by in BANDS for c in limits]))


@query("op13_tokeniser_fertility")
def op13_tokeniser_fertility(spark, sf_dir):
    import public_tokenizers
    judged = quality_rules(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "n_tokens", *MEASURES, "script", "band", "outside")
