"""Benchmark decontamination: n-gram and rare-word seeds, then Smith-Waterman alignment.

1. Test items become sequences of word numbers (equal items collapse to one). One pass over the
   documents counts, for every word of an item, the documents that hold it.
2. Every word 3-gram of an item is a seed, and so are its rarest words: an alignment without a
   common 3-gram pays an error for every two matches, so it needs about two thirds of the item's
   words to reach the score, and one word more than it may leave out cannot be missed by it.
3. A second pass joins passages to items on the seeds: a seed at word p of a document and word o
   of an item suggests the passage around diagonal p - o. Suggested passages that hold too few of
   the item's words for the score are passed over; every other one is aligned with its item word
   by word (match +2, mismatch -1, gap -1); the score is the best local alignment over that of an
   exact copy. Seeds, passages and the word count lose no alignment that reaches the score.

An alignment must also score as much as `MIN_MATCHED` words in a row; an item of fewer words matches only a
document that is an exact copy of it and nothing else.
Long items are aligned with few passages at a time, in bounded memory.

The test set is a stated query set: it is read in blocks of about `BLOCK_BYTES` of text, each of which
is sent to all tasks; documents are never shuffled and no candidate is dropped.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import query, read, texts

GRAM = 3               # words of a seed
BLOCK_BYTES = 4 << 20  # text of the test items sent to the tasks at once, about
MIN_SCORE = 0.5        # of the score of an exact copy
MIN_MATCHED = 5        # words: fewer are common in any text, so shorter items match whole documents only
MATCH, MISS, GAP = 2, -1, 1
CELLS_AT_ONCE = 1 << 19  # words of the passages aligned together
HITS_AT_ONCE = 1 << 20   # places of the seeds of a batch looked at together
LONG = 64                # bytes; longer words are looked up one by one
_WORDS = re.compile(r"\w+").findall
_MIX = np.int64(0x9E3779B97F4A7C15 - (1 << 64))  # packs n-grams; a collision suggests a passage in vain, no more

# Lower case of a byte that is a word character, 0 for others; what isn't ASCII stands for itself.
_LOWER = np.array([c if c > 127 else ord(chr(c).lower()) if _WORDS(chr(c)) else 0 for c in range(256)], np.uint8)
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)   # the first n of 8 bytes
_SIGMA = 0x3A3   # the only character whose lower case depends on its neighbours
_ODD = 1         # stands for characters whose lower case has another number of bytes, and for that one

SCHEMA = "doc_id long, item_id long, score double, start_word long, end_word long"


def words(text: str) -> list[str]:
    return _WORDS(text.lower())


@functools.cache
def lower_codes() -> np.ndarray:
    """Lower case of the characters up to 0xFFFF: 0 if it is no word character, _ODD for odd ones."""
    out = np.zeros(1 << 16, np.int32)
    for c in range(128, 1 << 16):
        low = chr(c).lower()
        same = len(low) == 1 and (ord(low) < 0x80, ord(low) < 0x800) == (c < 0x80, c < 0x800)
        out[c] = _ODD if not same or c == _SIGMA else ord(low) if _WORDS(low) else 0
    return out


def lower_bytes(raw: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Put the bytes of UTF-8 text into ``low``, those of word characters in lower case and 0 for others;
    gives the places of odd characters, which stay as they are."""
    np.take(_LOWER, raw, out=low[:len(raw)])
    lead = np.flatnonzero(raw > 0xBF)
    odd = [lead[raw[lead] > 0xEF]]
    for mark, n in ((0xC0, 2), (0xE0, 3)):
        at = lead[(raw[lead] >= mark) & (raw[lead] <= mark | 0xFF >> n + 1)]
        code = raw[at].astype(np.int32) & 0xFF >> n + 1
        for i in range(1, n):
            code = code << 6 | raw[at + i] & 63
        to = lower_codes()[code] if len(at) else code
        odd.append(at[to == _ODD])
        other = np.flatnonzero((to != code) & (to != _ODD))
        at, to = at[other], to[other]
        for i in range(n):
            low[at + i] = np.where(to > 0, (0x80 if i else mark) | to >> 6 * (n - 1 - i) & 63, 0)
    return np.sort(np.concatenate(odd))


class Items:
    """A block of test items as word numbers, and the n-grams they hold."""

    def __init__(self, rows: list[tuple[int, str]]):
        by_words: dict[tuple, int] = {}
        for item_id, text in rows:
            w = tuple(words(text or ""))
            if w and (w not in by_words or item_id < by_words[w]):
                by_words[w] = item_id
        self.ids = np.array(list(by_words.values()), np.int64)
        self.vocabulary: dict[str, int] = {}
        self.words = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], np.int64)
                      for w in by_words]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.spell()

    def spell(self) -> None:
        """``levels``: the words of the vocabulary up to LONG bytes, 8 bytes at a time. A level numbers these bytes, and
        them with what stands before; ``ends`` has the word that ends there."""
        self.levels = []
        live = [(0, b, n) for w, n in self.vocabulary.items() if len(b := w.encode()) <= LONG]
        while live:
            parts = [int.from_bytes(w[:8], "little") for _, w, _ in live]
            chunks = pd.Index(np.unique(np.array(parts, np.uint64)))
            pairs = np.array([s for s, _, _ in live], np.int64) * len(chunks) + chunks.get_indexer(np.array(parts, np.uint64))
            pairs, state = np.unique(pairs, return_inverse=True)
            ends = np.zeros(len(pairs), np.int32)
            for s, (_, w, n) in zip(state.tolist(), live):
                if len(w) <= 8:
                    ends[s] = n
            self.levels.append((chunks, pd.Index(pairs), ends))
            live = [(s, w[8:], n) for s, (_, w, n) in zip(state.tolist(), live) if len(w) > 8]

    def numbers(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of all texts, one text after the other (0: not in the vocabulary), and how
        many words each text has. The same as looking up `words` of each text."""
        column.validate(full=True)   # UTF-8
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        size = int(offsets[-1] - offsets[0])
        raw = np.frombuffer(column.buffers()[2], np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        low = np.zeros((size // 8 + 2) * 8, np.uint8)
        odd = lower_bytes(raw, low)
        inside = low[:size] > 0
        inner = offsets[(offsets > 0) & (offsets < size)]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        opens[inner], closes[inner - 1] = inside[inner], inside[inner - 1]
        start, length = np.flatnonzero(opens), np.flatnonzero(closes)
        length = length + 1 - start

        eight = low.view("<u8")
        out, live, state = np.zeros(len(start), np.int32), np.arange(len(start)), 0
        for k, (chunks, pairs, ends) in enumerate(self.levels):
            at, left = start[live] + 8 * k, length[live] - 8 * k
            word, shift = at >> 3, (at & 7).astype(np.uint64) * np.uint64(8)
            part = eight[word] >> shift | eight[word + 1] << np.uint64(63) - shift << np.uint64(1)
            chunk = chunks.get_indexer(part & _KEEP[np.minimum(left, 8)])
            state = pairs.get_indexer(np.where(chunk < 0, -1, state * len(chunks) + chunk)) if k else chunk
            done = np.flatnonzero((state >= 0) & (left <= 8))
            out[live[done]] = ends[state[done]]
            more = np.flatnonzero((state >= 0) & (left > 8))
            live, state = live[more], state[more]

        begin = np.searchsorted(start, offsets)
        long = np.flatnonzero(length > LONG)
        if not len(odd) and not len(long):
            return out, np.diff(begin)
        # Long words, words with an odd character and texts with a sigma, one by one.
        blob = raw.tobytes()
        sigma = odd[(raw[odd] == 0xC0 | _SIGMA >> 6) & (raw[np.minimum(odd + 1, size - 1)] == 0x80 | _SIGMA & 63)]
        whole = np.unique(np.searchsorted(offsets, sigma, "right") - 1)
        odd = np.union1d(np.searchsorted(start, odd, "right") - 1, long)
        odd = odd[~np.isin(np.searchsorted(begin, odd, "right") - 1, whole)]
        known: dict[bytes, list[int]] = {}
        count, at, instead = np.ones(len(out), np.int64), [], []
        for k, b, n in zip(odd.tolist(), start[odd].tolist(), length[odd].tolist()):
            token = blob[b:b + n]
            found = known.get(token)
            if found is None:
                found = known[token] = self.look_up(token.decode())
            at.append(k)
            instead.append(found)
        for d in whole.tolist():
            count[begin[d]:begin[d + 1]] = 0
            at.append(begin[d])
            instead.append(self.look_up(blob[offsets[d]:offsets[d + 1]].decode()))
        many = np.array([len(x) for x in instead], np.int64)
        count[at] = many
        behind = np.append(0, np.cumsum(count))
        out = np.repeat(out, count)
        out[np.repeat(behind[at] - np.cumsum(many) + many, many) + np.arange(many.sum())] = [n for x in instead for n in x]
        return out, np.diff(behind[begin])

    def look_up(self, text: str) -> list[int]:
        return [self.vocabulary.get(w, 0) for w in words(text)]

    def hits(self, numbers: np.ndarray, sizes: np.ndarray):
        """(position, index into ``seeds``) of every seed in texts that stand one after the other."""
        known = numbers > 0
        grams = known[:max(len(known) - GRAM + 1, 0)].copy()
        behind = np.cumsum(sizes)
        for i in range(1, GRAM):
            grams &= known[i:len(grams) + i]
            across = behind - i
            grams[across[(across >= 0) & (across < len(grams))]] = False
        at = [np.flatnonzero(known), np.flatnonzero(grams)]
        which = [self.word_seed[numbers[at[0]]],
                 self.seeds.get_indexer(join([numbers[at[1] + i].astype(np.int64) for i in range(GRAM)]))]
        at, which = np.concatenate(at), np.concatenate(which)
        return at[which >= 0], which[which >= 0]

    def choose_seeds(self, held_by: np.ndarray, min_score: float) -> None:
        """All n-grams of the items and, of each item, as many of its rarest words as leave too few
        others for ``min_score``. ``held_by``: documents holding each word number."""
        item, offset, gram = [], [], []
        for i, w in enumerate(self.words):
            least = least_score(len(w), min_score)
            # Runs of fewer than GRAM matches: at least one error between two of them.
            matches = max(-(-least // MATCH), -(-(least - 1) * (GRAM - 1) // (MATCH * (GRAM - 1) - 1)), 1)
            rare = np.lexsort((w, held_by[w]))[:max(len(w) - matches + 1, 0)]
            grams = join([w[k:max(len(w) - GRAM + 1, 0) + k] for k in range(GRAM)])
            item.append(np.full(len(rare) + len(grams), i))
            offset += [rare, np.arange(len(grams))]
            gram += [w[rare], grams]
        item, offset, gram = np.concatenate(item), np.concatenate(offset), np.concatenate(gram)
        order = np.argsort(gram, kind="stable")
        self.seed_item, self.seed_offset = item[order], offset[order]
        seeds, self.seed_first = np.unique(gram[order], return_index=True)
        self.seeds = pd.Index(seeds)
        self.word_seed = self.seeds.get_indexer(np.arange(len(self.vocabulary) + 1))
        self.seed_count = np.diff(np.append(self.seed_first, len(order)))


def least_score(size: int, min_score: float) -> int:
    """Alignment score that an item of ``size`` words needs: the share of an exact copy's, and that of
    MIN_MATCHED words in a row (or of all words, if it has fewer)."""
    return max(math.ceil(min_score * MATCH * size - 1e-9), MATCH * min(size, MIN_MATCHED))


def join(parts: list[np.ndarray]) -> np.ndarray:
    """n-grams of word numbers, given as the first, second... words of all, as one number each."""
    g = np.zeros(len(parts[0]), np.int64)
    for p in parts:
        g = g * _MIX + p
    return g | 1


def smith_waterman(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, column where it ends) of ``item`` against each row of ``passages``."""
    n, width = passages.shape
    step = np.arange(width, dtype=np.int32) * GAP
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for w in item:
        row = np.maximum(above[:, :-1] + np.where(passages == w, MATCH, MISS).astype(np.int32), above[:, 1:] - GAP)
        np.maximum(row, 0, out=row)
        # Gaps along the passage: the best cell on the left, less the gap between.
        row = np.maximum.accumulate(row + step, axis=1) - step
        at = row.argmax(axis=1)
        top = row[np.arange(n), at]
        higher = top > best
        best[higher], end[higher] = top[higher], at[higher]
        above[:, 1:] = row
    return best, end


def align(items: Items, numbers: np.ndarray, sizes: np.ndarray, doc: np.ndarray, item: np.ndarray, place: np.ndarray,
          min_score: float) -> dict:
    """Best (score, start, end) of each (document, item) over its suggested passages.
    ``numbers``, ``sizes``: the documents; ``doc``, ``item``, ``place``: as `suggest` gives them, by item."""
    if not len(item):
        return {}
    flat = np.append(numbers, np.int32(0))
    first = np.cumsum(sizes) - sizes
    kind_of = np.zeros(len(items.vocabulary) + 1, np.int32)   # of each word number, the how-manieth word of the item
    names, begins = np.unique(item, return_index=True)
    out: dict = {}
    for i, begin, stop in zip(names.tolist(), begins.tolist(), [*begins[1:].tolist(), len(item)]):
        w = items.words[i]
        size = len(w)
        least = least_score(size, min_score)
        margin = max(MATCH * size - least, 0)   # most inserted words an alignment can afford
        width = 2 * size + 2 * margin
        kinds, copies = np.unique(w, return_counts=True)
        kind_of[:] = 0
        kind_of[kinds] = np.arange(1, len(kinds) + 1)
        at_once = max(CELLS_AT_ONCE // width, 1)
        for k in range(begin, stop, at_once):
            part = slice(k, min(k + at_once, stop))
            owner, starts = doc[part], place[part] * size - margin
            at = starts[:, None] + np.arange(width)
            windows = np.where((at >= 0) & (at < sizes[owner][:, None]), flat[first[owner][:, None] + np.clip(at, 0, sizes[owner][:, None])], 0)
            # No alignment has more matches than the passage has words of the item.
            kind = kind_of[windows]
            some = np.flatnonzero(np.count_nonzero(kind, axis=1) * MATCH >= least)
            if not len(some):
                continue
            kind = kind[some]
            row, column = np.nonzero(kind)
            held = np.bincount(row * len(kinds) + kind[row, column] - 1, minlength=len(some) * len(kinds)).reshape(len(some), -1)
            enough = some[np.minimum(held, copies).sum(axis=1) * MATCH >= least]
            if size < MIN_MATCHED:
                enough = enough[sizes[owner[enough]] == size]
            if not len(enough):
                continue
            owner, starts, windows = owner[enough], starts[enough], windows[enough]
            best, end = smith_waterman(w, windows)
            good = np.flatnonzero(best >= least)
            if not len(good):
                continue
            # The start of an alignment is the end of the mirrored one.
            mirrored = np.zeros((len(good), width), np.int64)
            for r, g in enumerate(good):
                mirrored[r, :end[g] + 1] = windows[g, end[g]::-1]
            _, back = smith_waterman(w[::-1], mirrored)
            for r, g in enumerate(good):
                d, low = int(owner[g]), int(starts[g])
                entry = (float(best[g]) / (MATCH * size), -(low + int(end[g] - back[r])), low + int(end[g]) + 1)
                if entry > out.get((d, i), (0.0, 0, 0)):
                    out[d, i] = entry
    return out


def suggest(items: Items, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, place) of the passages that seeds suggest, by item: place q stands for the diagonals
    that begin in the q-th item length; `align` adds room on either side for all the insertions that
    the score leaves room for."""
    at, which = items.hits(numbers, sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)[at]
    at = at - (np.cumsum(sizes) - sizes)[doc]
    count = items.seed_count[which]
    room = np.cumsum(sizes + 2)   # places of a document: -1 to the number of its words
    slot = room - sizes - 2
    found = [np.zeros(0, np.int64)]
    cuts = np.unique(np.searchsorted(np.cumsum(count), np.arange(0, count.sum() + HITS_AT_ONCE, HITS_AT_ONCE)))
    for part in map(slice, cuts, [*cuts[1:], len(count)]):
        n = count[part]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        entry = np.repeat(items.seed_first[which[part]], n) + step
        item = items.seed_item[entry]
        place = np.floor_divide(np.repeat(at[part], n) - items.seed_offset[entry], items.lengths[item])
        found.append(np.unique(item * room[-1] + np.repeat(slot[doc[part]], n) + place + 1))
    item, rest = np.divmod(np.unique(np.concatenate(found)), room[-1])
    doc = np.searchsorted(slot, rest, "right") - 1
    return doc, item, rest - slot[doc] - 1


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): every test item a document holds a copy of,
    with the best aligned passage (word numbers, end exclusive). Equal items are reported under
    their smallest item_id. Documents without a copy give no row; null or empty texts and items
    hold and match nothing; items of fewer than MIN_MATCHED words match only documents without any other word; rows repeat if documents do. Null document ids are reported as null.
    """
    spark = docs.sparkSession
    body = texts(docs)
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-(bench.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // BLOCK_BYTES))
    out = None
    for k in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        items = Items([(-1 if r.item_id is None else r.item_id, r.text) for r in rows])
        if not items.words:
            continue
        part = _passages(body, items, min_score)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def _passages(body: DataFrame, items: Items, min_score: float) -> DataFrame:
    def count(batches):
        held = np.zeros(len(items.vocabulary) + 1, np.int64)
        for b in batches:
            numbers, sizes = items.numbers(b.column(0))
            some = np.flatnonzero(numbers)
            once = np.unique(np.repeat(np.arange(len(sizes)), sizes)[some] * len(held) + numbers[some])
            held += np.bincount(once % len(held), minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["word", "n"])

    held = np.zeros(len(items.vocabulary) + 1, np.int64)
    # One row for every word of the block at most.
    for r in body.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        held[r.word] = r.n
    items.choose_seeds(held, min_score)

    def passages(batches):
        for b in batches:
            if not len(b):
                continue
            ids = b.column(0)
            docs = items.numbers(b.column(1))
            rows = [(ids[d].as_py(), int(items.ids[i]) if items.ids[i] >= 0 else None, s, -start, end)
                    for (d, i), (s, start, end) in sorted(align(items, *docs, *suggest(items, *docs), min_score).items())]
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "score", "start_word", "end_word"])

    return body.mapInArrow(passages, SCHEMA)


@query("op1_decontamination")
def op1_decontamination(spark, sf_dir):
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
