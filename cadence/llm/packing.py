"""Best-fit packing of tokenized documents, improved by swap-based local search.

One pass over the documents: a task tokenizes its rows, cuts documents longer than the
capacity, and packs the pieces buffer by buffer. A buffer is packed best-fit decreasing; then
a local search over the underfull sequences moves one document, swaps one for one, or swaps
two for one, whenever that raises the sum of squared fills, until nothing does. Sequences that
are still underfull give their pieces to the next buffer. What a task has left at its end
(a few sequences) is packed again with the rest of 256 tasks. Memory is one buffer; the text
is never shuffled, and no step sees more than a buffer of piece lengths.

Ids come from `word_bpe_49k.json`. Its pre-tokenizer drops white space, so a text's ids are the
ids of its white-space-separated words in order; a worker therefore keeps a bounded cache of
word -> ids and asks the tokenizer only for words it hasn't seen.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import cut, query, read, texts

CAPACITY = 4096
END_ID = 1
BUFFER = 8192          # pieces packed together
CACHE = 1_000_000      # words kept by a worker
FINISH = 256           # tasks whose remainders are packed together
PLAIN = re.compile("[a-z\xdf-\xf6\xf8-\xff]+").fullmatch
INFORMATION_SEPARATORS = re.compile("[\x1c-\x1f]").search  # str.split() takes them for white space, the tokenizer doesn't

SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, "
          "fill long, open boolean, part int")


# Byte-level models name bytes by printable characters: those that have one keep it, the rest
# follow from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_NAMES = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit bytes: a bounded cache that asks the
    tokenizer for a word it misses. One letter run in Latin letters, with a full stop or comma
    at most, is lower-cased and goes to the model directly, since the tokenizer's normalizer and
    pre-tokenizer would leave it whole; anything else goes through the whole tokenizer."""

    by_path: dict = {}

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.table = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        self.cores: dict[str, bytes] = {}
        self.marks = {m: self._whole(m) for m in (".", ",")}

    @classmethod
    def get(cls, path: str) -> WordIds:
        if path not in cls.by_path:
            cls.by_path[path] = cls(path)
        return cls.by_path[path]

    def _whole(self, text: str) -> bytes:
        return b"".join([self.table[i] for i in self.whole.encode(text, add_special_tokens=False).ids])

    def __missing__(self, word: str) -> bytes:
        core, tail = word.lower(), b""
        if core[-1] in self.marks:
            core, tail = core[:-1], self.marks[core[-1]]
        ids = self.cores.get(core)
        if ids is None:
            if not PLAIN(core):
                self[word] = ids = self._whole(word)
                return ids
            name = core if core.isascii() else core.encode().decode("latin-1").translate(BYTE_NAMES)
            self.cores[core] = ids = b"".join([self.table[t.id] for t in self.model.tokenize(name)])
        self[word] = ids = ids + tail
        return ids

    def encode(self, batch: list[str]):
        """Bytes of the ids of each text, one after the other."""
        for text in batch:
            if INFORMATION_SEPARATORS(text):
                yield self._whole(text)
                continue
            if len(self) > CACHE:
                self.clear()
                self.cores.clear()
            yield b"".join(map(self.__getitem__, text.split()))


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of indexes into ``sizes``."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), ascending
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        if free > sizes[i]:
            insort(room, (free - sizes[i], b))
    return bins


def local_search(sizes: list[int], bins: list[list[int]], capacity: int, near: int = 4) -> list[list[int]]:
    """Raise the sum of squared fills by moves, one-for-one and two-for-one swaps between
    underfull bins until no such step is left; emptied bins are dropped. Every step takes
    tokens from a bin that is no fuller into another, so the sum rises strictly and it ends.
    Two-for-one swaps take their pairs from the ``near`` emptiest bins."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    home = {i: b for b, items in enumerate(bins) for i in items}
    active = {b for b in range(len(bins)) if fill[b] < capacity}
    pool = sorted((sizes[i], i) for b in active for i in bins[b])

    def relocate(items: list[int], source: int, target: int) -> None:
        for i in items:
            bins[source].remove(i)
            bins[target].append(i)
            home[i] = target
            fill[source] -= sizes[i]
            fill[target] += sizes[i]

    def donor(low: int, high: int, target: int):
        """Largest document with low < size <= high in a bin no fuller than target."""
        at = bisect_right(pool, (high, len(sizes)))
        while at and pool[at - 1][0] > low:
            i = pool[at - 1][1]
            if home[i] != target and home[i] in active and fill[home[i]] <= fill[target]:
                return i
            at -= 1
        return None

    changed = True
    while changed:
        changed = False
        order = sorted((b for b in active if bins[b]), key=lambda b: -fill[b])
        for target in order:
            while bins[target] and fill[target] < capacity:
                gap, best = capacity - fill[target], None
                i = donor(0, gap, target)
                if i is not None:
                    best = (sizes[i], [i], [])
                for j in bins[target]:
                    if best and best[0] == gap:
                        break
                    i = donor(sizes[j] + (best[0] if best else 0), sizes[j] + gap, target)
                    if i is not None:
                        best = (sizes[i] - sizes[j], [i], [j])
                if not best or best[0] < gap:
                    for source in [b for b in order[-near:] if b != target and fill[b] <= fill[target]]:
                        mine = sorted((sizes[i], i) for i in bins[source])
                        for j in bins[target]:
                            left, right = 0, len(mine) - 1  # two pointers over pair sums
                            while left < right:
                                gain = mine[left][0] + mine[right][0] - sizes[j]
                                if gain > gap:
                                    right -= 1
                                    continue
                                if gain > (best[0] if best else 0):
                                    best = (gain, [mine[left][1], mine[right][1]], [j])
                                left += 1
                if not best:
                    break
                source = home[best[1][0]]
                relocate(best[1], source, target)
                relocate(best[2], target, source)
                changed = True
            if fill[target] == capacity:
                active.discard(target)
        pool = sorted((sizes[i], i) for b in active for i in bins[b])
    return [b for b in bins if b]


class Packer:
    """Packs pieces (tuples whose fourth field is the length) buffer by buffer."""

    def __init__(self, capacity: int, first_id: int, part: int):
        self.capacity, self.next_id, self.part = capacity, first_id, part
        self.buffer: list[tuple] = []

    def _pack(self) -> list[tuple[int, list[tuple]]]:
        sizes = [p[3] for p in self.buffer]
        bins = local_search(sizes, best_fit_decreasing(sizes, self.capacity), self.capacity)
        return sorted(((sum(sizes[i] for i in b), [self.buffer[i] for i in sorted(b)]) for b in bins),
                      key=lambda x: -x[0])

    def _rows(self, packed, still_open: bool) -> list[tuple]:
        rows = []
        for total, pieces in packed:
            at = 0
            for p in pieces:
                rows.append((*p, self.next_id, at, total, still_open, self.part))
                at += p[3]
            self.next_id += 1
        return rows

    def add(self, piece: tuple) -> list[tuple]:
        if piece[3] == self.capacity:
            return self._rows([(self.capacity, [piece])], False)
        self.buffer.append(piece)
        if len(self.buffer) < BUFFER:
            return []
        packed = self._pack()
        # Underfull sequences are packed again with the next buffer, as long as they leave it half free.
        keep, held = len(packed), 0
        while keep and packed[keep - 1][0] < self.capacity and held + len(packed[keep - 1][1]) <= BUFFER // 2:
            keep -= 1
            held += len(packed[keep][1])
        self.buffer = [p for _, pieces in packed[keep:] for p in pieces]
        return self._rows(packed[:keep], False)

    def finish(self, last: bool) -> list[tuple]:
        packed, self.buffer = self._pack(), []
        full = [x for x in packed if x[0] == self.capacity]
        return self._rows(full, False) + self._rows(packed[len(full):], not last)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64()),
                   ("open", pa.bool_()), ("part", pa.int32())])


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, fill): one row per piece.

    Null and empty texts are one piece holding the end id alone; documents with a null or
    repeated id are packed like others. An empty table gives no rows. ``fill`` is the length
    of the piece's sequence. ``tokenizer`` is the path of the vocabulary file, which every
    worker has.
    """
    end = end_id.to_bytes(4, "little")

    def first(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        ids, packer = WordIds.get(tokenizer), Packer(capacity, part << 32, part)
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), ids.encode(batch.column(1).to_pylist())):
                data += end
                total = len(data) // 4
                for k, start in enumerate(range(0, total, capacity)):
                    n = min(capacity, total - start)
                    rows += packer.add((doc_id, k, start, n, zlib.crc32(data[4 * start:4 * (start + n)])))
            if rows:
                yield _table(rows, ARROW)
        if rows := packer.finish(last=False):
            yield _table(rows, ARROW)

    def finish(batches):
        packer, group = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["part"] // FINISH != group:
                    if packer:
                        rows += packer.finish(last=True)
                    group = r["part"] // FINISH
                    packer = Packer(capacity, (1 << 62) + (group << 32), r["part"])
                rows += packer.add((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]))
            if rows:
                yield _table(rows, ARROW)
        if packer and (rows := packer.finish(last=True)):
            yield _table(rows, ARROW)

    packed = cut(texts(docs).mapInArrow(first, SCHEMA))
    group = F.floor(F.col("part") / FINISH)
    rest = (packed.filter("open").repartition(group).sortWithinPartitions(group, "part", "sequence_id", "offset")
            .mapInArrow(finish, SCHEMA))
    return packed.filter("not open").unionByName(rest).drop("open", "part")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_packing")
def op4_packing(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())
