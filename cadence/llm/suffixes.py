"""Repeated passages by a logarithmic family of suffix indexes.

A byte goes if a 50-byte string over it also starts in a document with a smaller id. Documents
are written once in blocks; every block is a new batch. A batch's suffix array is sparse: of
every 50-byte string it holds the suffix at its minimizer (the 16-byte string inside that has
the smallest hash), so equal 50-byte strings are always represented by equal entries. Strings
next to each other with one minimizer form a run and share an entry: the hash of the 16 bytes,
the hash of all bytes of the run, and the document. Arrays are sorted by the first hash and
dealt to key buckets, where the family lives: each batch becomes a level, levels of about
equal size merge geometrically. After the last batch the levels are settled into one array, and
the batches' entries are looked up in it: what goes depends on the smallest document over all
batches, later ones too, and one array answers that in one lookup. No level outlives a run. Two
rounds make it exact:

1. A run whose whole content also stands in a smaller document goes as a whole. Two runs with one
   minimizer and different contents can share a 50-byte string only if the 17 bytes on the left of
   it or the 17 on its right are equal; entries carry 8-bit hashes of both, and a run that agrees
   with another in one of them is open.
2. Of open runs every 50-byte string is looked up by its own hash in the same way.

Then each block marks the bytes. Keys and strings have 64-bit hashes; texts move once, into the
blocks.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.blocks import GOLDEN, by_bucket, layout, mix, write_blocks
from cadence.llm.common import cut, query, read, texts

LENGTH = 50
GRAM = 16                  # bytes of a minimizer
PIECE = 1 << 18            # bytes of documents hashed together, so that arrays stay in cache
SIDE = (LENGTH - GRAM) // 2  # bytes on one side of the minimizer that a string must have, left or right
CLEAN, GONE, OPEN = 0, 1, 2
ABSENT, ANY = 0, 255       # sides that agree with none, and with all

_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


@lru_cache(maxsize=4)
def _table(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return _table(int(base), PIECE + LENGTH)[:n] if n <= PIECE + LENGTH else _table.__wrapped__(int(base), n)


class Runs:
    """Runs of 50-byte strings with one minimizer, over some documents (or a part of one) set end to end.
    ``start`` and ``size``: first string and number of strings of each run, as places in ``data``."""

    def __init__(self, data: bytes, length: np.ndarray):
        self.data = np.frombuffer(data, np.uint8)
        n, w = len(self.data), LENGTH - GRAM + 1
        self.doc = np.repeat(np.arange(len(length), dtype=np.int32), length)
        self.start = self.size = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        # The eight bytes from every place as one number; two of them make a 16-byte hash.
        words = np.empty(n, "<u8")
        padded = data + bytes(8)
        for o in range(8):
            part = np.frombuffer(padded, "<u8", (n - o + 7) // 8, o)
            words[o::8] = part[:len(words[o::8])]
        h = mix(words[:n - GRAM + 1] * GOLDEN + words[GRAM - 8:n - GRAM + 1 + GRAM - 8])
        self.words, self.hashes = words, h
        least, reach = h, 1
        while reach * 2 <= w:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < w:
            least = np.minimum(least[:len(least) - (w - reach)], least[w - reach:])
        inside = self.doc[:n - LENGTH + 1] == self.doc[LENGTH - 1:]
        fresh = np.ones(len(least), bool)
        fresh[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
        # Two documents end to end: between them lie 49 places without a string.
        edge = np.flatnonzero(fresh & inside)
        self.start = edge
        stop = np.empty(len(edge), np.int64)
        bounds = np.flatnonzero(fresh | ~inside)
        after = np.searchsorted(bounds, edge, side="right")
        stop = np.append(bounds, len(least))[after]
        self.size = stop - edge
        self.least = least[edge]
        self.key = mix(self.least + np.uint64(1))

    def sides(self) -> np.ndarray:
        """8-bit hashes of the `SIDE` bytes left (high byte) and right of each run's minimizer. A
        side that none of the run's strings has in full is `ABSENT`; runs that a repeated
        minimizer made have no one place for it and are `ANY`. Functions of the run's content."""
        w = LENGTH - GRAM + 1
        one = self.size <= w
        view = np.lib.stride_tricks.sliding_window_view(self.hashes, w)
        place = np.zeros(len(self.start), np.int64)
        for k in range(0, len(self.start), 4096):
            at = self.start[k:k + 4096]
            same = view[at] == self.least[k:k + 4096, None]
            one[k:k + 4096] &= same.sum(axis=1) == 1
            place[k:k + 4096] = at + same.argmax(axis=1)
        one &= place >= self.start + self.size - 1
        left = one & (place - self.start >= SIDE)
        right = one & (LENGTH - GRAM - (place - self.start - self.size + 1) >= SIDE)
        out = []
        for has, first in ((left, place - SIDE), (right, place + GRAM)):
            f = first[has]
            h = np.full(len(place), ABSENT, np.uint64)
            h[has] = mix(mix(self.words[f] * GOLDEN + self.words[f + 8]) + self.words[f + SIDE - 8]) % np.uint64(254) + np.uint64(1)
            out.append(np.where(one, h, np.uint64(ANY)))
        return out[0] << np.uint64(8) | out[1]

    def content(self) -> np.ndarray:
        """48-bit hash of all bytes of each run, its length included, then the hashes of its sides."""
        n = len(self.data)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * _powers(_BASE, n), out=prefix[1:])
        low, high = self.start, self.start + self.size + LENGTH - 1
        h = mix((prefix[high] - prefix[low]) * _powers(_BASE_INVERSE, n)[low] + self.size.astype(np.uint64) * GOLDEN)
        return h & ~np.uint64(0xFFFF) | self.sides()

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(run, hash) of every 50-byte string of the runs ``which``, in order."""
        size = self.size[which]
        run = np.repeat(which, size)
        at = np.repeat(self.start[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        data = self.data.tobytes() + bytes(8)
        view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), 8)
        h = np.zeros(len(at), np.uint64)
        for o in (0, 8, 16, 24, 32, 40, LENGTH - 8):
            h = mix(h * GOLDEN + np.ascontiguousarray(view[at + o]).view("<u8")[:, 0])
        return run, h


def pieces(encoded: list[bytes]):
    """(documents' numbers, places in them, their bytes end to end, lengths): `PIECE` bytes of whole
    documents, or `PIECE` strings of a longer one. Pieces of a document overlap by one byte less
    than a string, so that every string begins in exactly one."""
    low = 0
    while low < len(encoded):
        if len(encoded[low]) > PIECE + LENGTH - 1:
            for at in range(0, len(encoded[low]) - LENGTH + 1, PIECE):
                part = encoded[low][at:at + PIECE + LENGTH - 1]
                yield np.array([low]), np.array([at]), part, np.array([len(part)])
            low += 1
            continue
        high, held = low, 0
        while high < len(encoded) and (high == low or held + len(encoded[high]) <= PIECE):
            held += len(encoded[high])
            high += 1
        yield np.arange(low, high), np.zeros(high - low, np.int64), b"".join(encoded[low:high]), np.array([len(e) for e in encoded[low:high]])
        low = high


class Family:
    """Levels of sorted (key, content) entries with the smallest document of each. A batch is one level; a level merges with the next while that is at most
    twice its size, so there are logarithmically many and an entry is merged as often."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @staticmethod
    def _level(key: np.ndarray, content: np.ndarray, doc: np.ndarray):
        # Sorted runs are merged by the stable sort; only entries that share a key are sorted further.
        order = np.argsort(key, kind="stable")
        key, content, doc = key[order], content[order], doc[order]
        same = key[1:] == key[:-1]
        tied = np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False]))) if len(key) else np.zeros(0, int)
        inner = tied[np.lexsort((doc[tied], content[tied], key[tied]))]
        content[tied], doc[tied] = content[inner], doc[inner]
        first = np.ones(len(key), bool)
        first[1:] = ~same | (content[1:] != content[:-1])
        return key[first], content[first], doc[first]

    def add(self, key: np.ndarray, content: np.ndarray, doc: np.ndarray) -> None:
        level = self._level(key, content, doc)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            level = self._level(*map(np.concatenate, zip(self.levels.pop(), level)))
        self.levels.append(level)

    def settle(self) -> None:
        """Merge what levels are left into one."""
        while len(self.levels) > 1:
            self.levels.append(self._level(*map(np.concatenate, zip(self.levels.pop(), self.levels.pop()))))

    def agreeing(self) -> np.ndarray:
        """For every entry of a settled family: does another content of its key agree on a side?"""
        key, content, _ = self.levels[0]
        out = np.zeros(len(key), bool)
        same = key[1:] == key[:-1]
        if not same.any():
            return out
        several = np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False])))
        new = np.ones(len(several), bool)
        new[1:] = key[several[1:]] != key[several[:-1]]
        group = np.cumsum(new) - 1
        agree, any_side = np.zeros(len(several), bool), np.zeros(len(several), bool)
        for shift in (8, 0):
            side = (content[several] >> np.uint64(shift)) & np.uint64(0xFF)
            any_side |= side == ANY
            code = group.astype(np.uint64) << np.uint64(8) | side
            _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
            agree |= (count[inverse] > 1) & (side != ABSENT)
        out[several] = agree | (np.bincount(group, any_side)[group] > 0)
        return out

    def find(self, key: np.ndarray, content: np.ndarray) -> np.ndarray:
        """Where the entries of a batch stand in the settled family; all of them are there."""
        k, c, _ = self.levels[0]
        at, high = np.searchsorted(k, key), np.searchsorted(k, key, side="right")
        several = np.flatnonzero(high - at > 1)
        # Contents are ascending within a key: binary search in all ranges at once.
        a, b, want = at[several], high[several] - 1, content[several]
        while (a < b).any():
            middle = (a + b) // 2
            less = c[middle] < want
            a, b = np.where(less, middle + 1, a), np.where(less, b, middle)
        at[several] = a
        return at


def _rows(block: int, edge: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """A binary row per bucket that ``columns``, ordered by bucket, have entries for."""
    some = np.flatnonzero(edge[1:] > edge[:-1])
    return pa.Table.from_pydict({"block": pa.array(np.full(len(some), block, np.int64)), "bucket": pa.array(some, pa.int32())} | {
        n: pa.array([c[edge[k]:edge[k + 1]].tobytes() for k in some], pa.binary()) for n, c in columns.items()})


def _documents(t: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Texts as bytes, and ids; a null id counts as larger than all others."""
    ids = t.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
    return t.column("text").cast(pa.binary()).to_pylist(), ids


def _all_runs(t: pa.Table, contents: bool = False):
    """(bytes, ids, [(document numbers, places, Runs)], key, content if asked for, doc) of a block,
    runs of all pieces in order."""
    encoded, ids = _documents(t)
    parts, key, content, doc = [], [], [], []
    for numbers, places, data, length in pieces(encoded):
        r = Runs(data, length)
        if len(r.start):
            parts.append((numbers, places, r))
            key.append(r.key)
            if contents:
                content.append(r.content())
            r.words = r.hashes = None  # 16 bytes for each byte of the block, not needed any more
            doc.append(ids[numbers[r.doc[r.start]]])
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return encoded, ids, parts, join(key, np.uint64), join(content, np.uint64), join(doc, np.int64)


def _codes(t: pa.Table, order: np.ndarray) -> np.ndarray:
    """Answers to a block, bucket after bucket, back in the order of its runs or strings."""
    import zstandard
    open_up = zstandard.ZstdDecompressor().decompress
    by = np.argsort(t.column("bucket").to_numpy())
    got = [np.frombuffer(open_up(v), np.uint8) for v in t.column("codes").take(pa.array(by)).to_pylist()]
    out = np.zeros(len(order), np.uint8)
    if got:
        out[order] = np.concatenate(got)
    return out


def _answers(blocks: list, bucket: int, codes: list[np.ndarray]) -> pa.Table:
    import zstandard
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pa.Table.from_arrays([pa.array(blocks, pa.int64()), pa.array([bucket] * len(blocks), pa.int32()),
                                 pa.array([squeeze(c.astype(np.uint8).tobytes()) for c in codes], pa.binary())],
                                names=["block", "bucket", "codes"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): one row per document; kept is
    the bytes that stay.

    Null texts count as empty. Documents with equal ids never remove from each other, and a
    null id counts as larger than any other. An empty table gives no rows.
    """
    body = texts(docs)
    block_bytes, parts, buckets = layout(body)
    blocks = write_blocks(body, block_bytes, parts)

    def ask_runs(t: pa.Table) -> pa.Table:
        _, _, _, key, content, doc = _all_runs(t, contents=True)
        order, edge = by_bucket(key, buckets)
        return _rows(t.column("block")[0].as_py(), edge, key=key[order], content=content[order], doc=doc[order])

    def answer_runs(t: pa.Table) -> pa.Table:
        family, batches = Family(), []
        for k, c, d in zip(*(t.column(n).to_pylist() for n in ("key", "content", "doc"))):
            batches.append((np.frombuffer(k, np.uint64), np.frombuffer(c, np.uint64), np.frombuffer(d, np.int64)))
            family.add(*batches[-1])
        family.settle()
        smallest, agreeing, codes = family.levels[0][2], family.agreeing(), []
        for key, content, doc in batches:
            at = family.find(key, content)
            codes.append(np.where(smallest[at] < doc, GONE, np.where(agreeing[at], OPEN, CLEAN)))
        return _answers(t.column("block").to_pylist(), t.column("bucket")[0].as_py(), codes)

    def open_strings(parts, code):
        """(run, hash) of the strings of open runs; runs are numbered over all parts of the block."""
        run, hashes, before = [], [], 0
        for _, _, r in parts:
            which = np.flatnonzero(code[before:before + len(r.start)] == OPEN)
            if len(which):
                a, h = r.strings(which)
                run.append(a + before)
                hashes.append(h)
            before += len(r.start)
        return (np.concatenate(run), np.concatenate(hashes)) if run else (np.zeros(0, np.int64), np.zeros(0, np.uint64))

    def ask_strings(t: pa.Table, a: pa.Table) -> pa.Table:
        _, _, parts, key, _, doc = _all_runs(t)
        run, h = open_strings(parts, _codes(a, by_bucket(key, buckets)[0]))
        order, edge = by_bucket(h, buckets)
        return _rows(t.column("block")[0].as_py() if t.num_rows else -1, edge, key=h[order], doc=doc[run][order])

    def answer_strings(t: pa.Table) -> pa.Table:
        family, batches = Family(), []
        for k, d in zip(*(t.column(n).to_pylist() for n in ("key", "doc"))):
            key = np.frombuffer(k, np.uint64)
            batches.append((key, np.zeros(len(key), np.uint64), np.frombuffer(d, np.int64)))
            family.add(*batches[-1])
        family.settle()
        codes = [family.levels[0][2][family.find(key, content)] < doc for key, content, doc in batches]
        return _answers(t.column("block").to_pylist(), t.column("bucket")[0].as_py(), codes)

    def remove(t: pa.Table, a: pa.Table) -> pa.Table:
        step = a.column("step").to_numpy() if a.num_rows else np.zeros(0, np.int64)
        encoded, ids, parts, key, _, _ = _all_runs(t)
        code = _codes(a.filter(pa.array(step == 1)), by_bucket(key, buckets)[0])
        run, h = open_strings(parts, code)
        hit = _codes(a.filter(pa.array(step == 2)), by_bucket(h, buckets)[0])
        masks: dict[int, np.ndarray] = {}
        before = 0
        for numbers, places, r in parts:
            n = len(r.start)
            mine = code[before:before + n]
            change = np.zeros(len(r.data) + 1, np.int64)
            gone = np.flatnonzero(mine == GONE)
            np.add.at(change, r.start[gone], 1)
            np.add.at(change, r.start[gone] + r.size[gone] + LENGTH - 1, -1)
            low, high = np.searchsorted(run, [before, before + n])
            if high > low:
                number = run[low:high] - before
                fresh = np.ones(len(number), bool)
                fresh[1:] = number[1:] != number[:-1]
                first = np.flatnonzero(fresh)
                at = r.start[number] + np.arange(len(number)) - np.repeat(first, np.diff(np.append(first, len(number))))
                at = at[hit[low:high] > 0]
                np.add.at(change, at, 1)
                np.add.at(change, at + LENGTH, -1)
            cover = np.cumsum(change[:-1]) > 0
            edge = np.searchsorted(r.doc, np.arange(len(numbers) + 1))
            for i in np.unique(r.doc[cover]):
                d, part = int(numbers[i]), cover[edge[i]:edge[i + 1]]
                mask = masks.setdefault(d, np.zeros(len(encoded[d]), bool))
                mask[places[i]:places[i] + len(part)] |= part
            before += n
        removed, spans, kept = np.zeros(len(encoded), np.int64), np.zeros(len(encoded), np.int64), list(encoded)
        for d, mask in masks.items():
            removed[d] = mask.sum()
            spans[d] = mask[0] + (mask[1:] & ~mask[:-1]).sum()
            kept[d] = np.frombuffer(encoded[d], np.uint8)[~mask].tobytes()
        return pa.Table.from_arrays([
            t.column("doc_id"), pa.array([len(e) for e in encoded], pa.int64()), pa.array(removed), pa.array(spans),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    answered = "block long, bucket int, codes binary"
    runs = cut(blocks.groupBy("block").applyInArrow(ask_runs, "block long, bucket int, key binary, content binary, doc binary")
               .groupBy("bucket").applyInArrow(answer_runs, answered))
    strings = cut(blocks.groupBy("block").cogroup(runs.groupBy("block"))
                  .applyInArrow(ask_strings, "block long, bucket int, key binary, doc binary")
                  .groupBy("bucket").applyInArrow(answer_strings, answered))
    both = runs.withColumn("step", F.lit(1)).unionByName(strings.withColumn("step", F.lit(2)))
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")
