"""Language-model scoring with a weighted backoff automaton.

The automaton has an empty state and one state per training word. A state's arcs are the
bigrams seen after its word; its failure arc leads to the empty state, whose arcs are the
unigrams of the contract, known words and unknown ones. With C the number of times a state's
word was followed, the failure arc weighs r(C) = k / (k + C**0.25), and an arc to w weighs
(1 - r(C)) c(w) / C + r(C) p(w), so the weights of a state sum to one; k is solved so that the
expected failure mass is the share of bigrams seen once (Good-Turing), from counts over all
training tokens. Of order 2, a state is the word before, so the state of each token is known without
walking: a text's transitions are looked up all at once, the arc if there is one, else the failure arc and the
unigram, and their log10 weights are added up from left to right. Tests hold this against an explicit
automaton that is walked token by token.

Counts of the whole corpus fit no worker, so each block of documents gets the slice of the
automaton its own texts can walk: it sends its distinct words and bigrams with their counts
to key buckets, which add them up over all blocks and send back the totals. Both ways the data
are packed arrays, grow with the distinct bigrams of the blocks, and nothing is pruned.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.blocks import GOLDEN, by_bucket, layout, mix, write_blocks
from cadence.llm.common import crc_mod, cut, query, read

START, END = b"\n", b" "   # no word contains white space
GROWTH = 0.25              # of a state's failure mass with its count
CLASSES = 64               # of counts, by powers of two


class Block:
    """Words and bigrams of a block's documents, as local numbers and global keys."""

    def __init__(self, texts: list[str], train: np.ndarray, buckets: int):
        import xxhash
        seq: list[bytes] = []
        length = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            words = text.encode("utf-8", "surrogatepass").lower().split()
            length[i] = len(words) + 2
            seq.append(START)
            seq += words
            seq.append(END)
        local: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter(map(local.__getitem__, seq), np.int64, len(seq))
        keys = np.fromiter(map(xxhash.xxh64_intdigest, local), np.uint64, len(local))
        self.first = np.concatenate(([0], np.cumsum(length)[:-1]))
        self.length = length
        start = np.zeros(len(seq), bool)
        start[self.first] = True
        self.token = np.flatnonzero(~start)              # what is scored: words and ends
        weight = np.repeat(train, length).astype(np.int64)
        code = ids[self.token - 1] * len(local) + ids[self.token]
        pairs, inverse = np.unique(code, return_inverse=True)
        pair_keys = mix(keys[pairs // len(local)] * GOLDEN + keys[pairs % len(local)])
        order, self.word_edge = by_bucket(keys, buckets)
        self.word = _inverse(order)[ids]                 # of every position, as place in the request
        self.word_keys, self.word_counts = keys[order], np.bincount(self.word, weight, len(keys)).astype(np.uint32)
        self.start = int(self.word[0]) if len(seq) else 0
        order, self.pair_edge = by_bucket(pair_keys, buckets)
        self.pair = _inverse(order)[inverse]             # of every token: the bigram that ends there
        self.pair_keys = pair_keys[order]
        self.pair_counts = np.bincount(self.pair, weight[self.token], len(pairs)).astype(np.uint32)


def _inverse(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def _u64(b) -> np.ndarray:
    return np.frombuffer(b, np.uint64)


def _u32(b) -> np.ndarray:
    return np.frombuffer(b, np.uint32)


def totals(requests: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sum the counts of equal keys over the requests (keys, counts): the sums in the order of
    each request; the distinct keys and their sums."""
    keys = np.concatenate([k for k, _ in requests])
    unique, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, np.concatenate([c for _, c in requests]), len(unique)).astype(np.int64)
    return np.split(total[inverse], np.cumsum([len(k) for k, _ in requests])[:-1]), unique, total


def solve_mass(tokens: np.ndarray, counts: np.ndarray, share: float) -> float:
    """k with sum(tokens * k / (k + counts**GROWTH)) / sum(tokens) = share."""
    if not tokens.sum():
        return 1.0
    low, high = 1e-9, 1e9
    for _ in range(200):
        k = (low * high) ** 0.5
        if (tokens * k / (k + counts ** GROWTH)).sum() / tokens.sum() < share:
            low = k
        else:
            high = k
    return k


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per document.

    Learns from the rows that are not ``held_out``. Tokens: words with A-Z lower-cased, then one
    end. Null and empty texts are one end token. Repeated rows count and come out as often as
    they are there; null ids stay null. An empty table gives no rows.
    """
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out).alias("train"),
                       F.coalesce("text", F.lit("")).alias("text"))
    block_bytes, parts, buckets = layout(body)
    blocks = write_blocks(body, block_bytes, parts)

    def ask(t: pa.Table) -> pa.Table:
        b = Block(t.column("text").to_pylist(), t.column("train").to_numpy().astype(bool), buckets)
        rows = []
        for k in range(buckets):
            w, p = slice(b.word_edge[k], b.word_edge[k + 1]), slice(b.pair_edge[k], b.pair_edge[k + 1])
            if w.start < w.stop or p.start < p.stop:
                rows.append((k, b.word_keys[w].tobytes(), b.word_counts[w].tobytes(), b.pair_keys[p].tobytes(), b.pair_counts[p].tobytes()))
        columns = list(zip(*rows)) or [[]] * 5
        return pa.Table.from_arrays([pa.array(np.full(len(rows), t.column("block")[0].as_py(), np.int64)),
                                     pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                                    names=["block", "bucket", "words", "word_counts", "pairs", "pair_counts"])

    def answer(t: pa.Table) -> pa.Table:
        import xxhash
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=1).compress
        c = {n: t.column(n).to_pylist() for n in ("words", "word_counts", "pairs", "pair_counts")}
        word, unique, total = totals([(_u64(k), _u32(n)) for k, n in zip(c["words"], c["word_counts"])])
        pair, _, pair_total = totals([(_u64(k), _u32(n)) for k, n in zip(c["pairs"], c["pair_counts"])])
        # Followed as often as they occur: words, and the start instead of the end.
        real = (total > 0) & (unique != np.uint64(xxhash.xxh64_intdigest(START)))
        followed = (total > 0) & (unique != np.uint64(xxhash.xxh64_intdigest(END)))
        level = np.log2(total[followed]).astype(np.int64)
        stats = np.concatenate([[total[real].sum(), real.sum(), (pair_total == 1).sum()],
                                np.bincount(level, total[followed], CLASSES),
                                np.bincount(level, total[followed].astype(float) ** 2, CLASSES)])
        n, bucket = t.num_rows, t.column("bucket")[0].as_py()
        pack = lambda xs: [squeeze(x.astype(np.uint64).tobytes()) for x in xs]
        return pa.Table.from_arrays([
            pa.array([*t.column("block").to_pylist(), -1], pa.int64()), pa.array([bucket] * (n + 1), pa.int32()),
            pa.array([*pack(word), None], pa.binary()), pa.array([*pack(pair), None], pa.binary()),
            pa.array([None] * n + [stats.tolist()], pa.list_(pa.float64()))], names=["block", "bucket", "words", "pairs", "stats"])

    requests = blocks.groupBy("block").applyInArrow(
        ask, "block long, bucket int, words binary, word_counts binary, pairs binary, pair_counts binary")
    answers = cut(requests.groupBy("bucket").applyInArrow(
        answer, "block long, bucket int, words binary, pairs binary, stats array<double>"))
    place = F.posexplode("stats").alias("at", "x")
    # One row per bucket and statistic: sums, so no more than 131 rows reach the driver.
    sums = {r["at"]: r.x for r in answers.filter("block = -1").select(place).groupBy("at").agg(F.sum("x").alias("x")).collect()}
    got = np.array([sums.get(i, 0.0) for i in range(3 + 2 * CLASSES)])
    tokens, distinct, once = int(got[0]), int(got[1]), got[2]
    mass, square = got[3:3 + CLASSES], got[3 + CLASSES:]
    some = mass > 0
    share = min(max(once / max(mass.sum(), 1), 1e-6), 1 - 1e-6)
    k = solve_mass(mass[some], square[some] / mass[some], share)  # a class stands at its tokens' mean count

    def score(t: pa.Table, a: pa.Table) -> pa.Table:
        import zstandard
        open_up = zstandard.ZstdDecompressor().decompress
        train = t.column("train").to_numpy().astype(bool)
        b = Block(t.column("text").to_pylist(), train, buckets)
        order = np.argsort(a.column("bucket").to_numpy())
        word, pair = (np.concatenate([_u64(open_up(v)) for v in a.column(n).take(pa.array(order)).to_pylist()]).astype(np.float64)
                      for n in ("words", "pairs"))
        seen = word[b.word][b.token]
        empty = (seen + 0.5) / (tokens + 0.5 * (distinct + 1))   # arcs of the empty state
        followed = word[b.word][b.token - 1]                     # of the state that each token is read in
        arcs = pair[b.pair]
        fail = np.where(followed > 0, k / (k + np.maximum(followed, 1) ** GROWTH), 1.0)
        base = np.log10(empty)
        weight = np.where(arcs > 0, np.log10((1 - fail) * arcs / np.maximum(followed, 1) + fail * empty), np.log10(fail) + base)
        edge = b.first - np.arange(len(b.first))                 # first token of each document
        add = lambda x: np.add.reduceat(x, edge)
        return pa.Table.from_arrays([
            t.column("doc_id"), pa.array(~train), pa.array(b.length - 1), pa.array(add((seen > 0).astype(np.int64))),
            pa.array(np.full(len(train), tokens, np.int64)), pa.array(add(base)), pa.array(add(weight))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.groupBy("block").cogroup(answers.filter("block >= 0").drop("stats").groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


@query("op3_lm_scoring")
def op3_lm_scoring(spark, sf_dir):
    return score_documents(read(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)
