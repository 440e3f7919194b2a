"""SimHash near-duplicates, found with BK-trees over shards of the fingerprints.

Fingerprints are computed in Arrow batches and collapsed to distinct values. To link values
at most r bits apart, the 64 bits are cut into r + 2 blocks: two such values agree on at least
two blocks, so every value goes to the shard of each pair of blocks (15 for r = 4), and
values that share no shard need not be compared. A shard is a BK-tree: the children of a node
are keyed by their Hamming distance to it, and a search with radius r follows only edges
within r of its own distance. A shard of more than `TREE` values is split into sub-trees, and
each sub-tree is sent to each query part of that shard, so no task holds more than two parts.
Trees of a batch are built and searched together, level by level, in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import cut, query, read, texts
from cadence.llm.components import connected_components, join_labels

SEED = 42
TREE = 4096
QUERIES_AT_ONCE = 512


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of a text: lower-cased A-Z, words between ASCII white space, ``shingle``-word
    shingles with repeats (fewer words: one shingle of all; none: 0), XXH64 with seed 42."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    n = len(words) - shingle + 1
    grams = map(joined.__getitem__, map(slice, start[:n].tolist(), end[shingle - 1:].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, bits long): the fingerprint as a signed 64-bit number. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            bits = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return texts(docs).mapInArrow(run, "doc_id long, bits long")


class Forest:
    """BK-trees of many shards. ``run`` numbers the shard of each value, ascending."""

    def __init__(self, run: np.ndarray, value: np.ndarray):
        self.value = value
        n = len(value)
        self.runs, root = np.unique(run, return_index=True)
        self.root = root
        at = root[np.searchsorted(self.runs, run)]
        waiting = np.setdiff1d(np.arange(n), root)
        edges = []
        while len(waiting):
            node = at[waiting]
            edge = node * 65 + np.bitwise_count(value[waiting] ^ value[node]).astype(np.int64)
            key, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
            child = waiting[first]
            edges.append(np.stack([key, child]))
            at[waiting] = child[inverse]
            keep = np.ones(len(waiting), bool)
            keep[first] = False
            waiting = waiting[keep]
        both = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        order = np.argsort(both[0])
        self.edge, self.child = both[0][order], both[1][order]

    def within(self, run: np.ndarray, value: np.ndarray, radius: int):
        """Pairs (index into the queries, index into the trees' values) at most ``radius`` apart."""
        q = np.arange(len(value))
        node = self.root[np.searchsorted(self.runs, run)]
        out_q, out_n = [], []
        while len(q):
            d = np.bitwise_count(value[q] ^ self.value[node]).astype(np.int64)
            near = d <= radius
            out_q.append(q[near])
            out_n.append(node[near])
            low = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), side="right")
            count = high - low
            q = np.repeat(q, count)
            step = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
            node = self.child[np.repeat(low, count) + step]
        return np.concatenate(out_q), np.concatenate(out_n)


def link_batch(run: np.ndarray, value: np.ndarray, tree: np.ndarray, search: np.ndarray, radius: int):
    """Links that join, in every run, all values within ``radius`` of each other: pairs of row
    indexes (row, smallest row of its class). ``tree`` rows form the trees, ``search`` rows search."""
    rows_t, rows_q = np.flatnonzero(tree), np.flatnonzero(search)
    forest = Forest(run[rows_t], value[rows_t])
    rows_q = rows_q[np.isin(run[rows_q], forest.runs)]
    label = np.arange(len(value))
    for i in range(0, len(rows_q), QUERIES_AT_ONCE):
        rows = rows_q[i:i + QUERIES_AT_ONCE]
        q, node = forest.within(run[rows], value[rows], radius)
        label = join_labels(label, rows[q], rows_t[node])
    moved = np.flatnonzero(label != np.arange(len(value)))
    return moved, label[moved]


def blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of radius + 2 blocks of the 64 bits, as even as can be."""
    n, out, at = radius + 2, [], 0
    for i in range(n):
        width = 64 // n + (i < 64 % n)
        out.append((at, (1 << width) - 1))
        at += width
    return out


def _complete_runs(batches: Iterator[pa.RecordBatch]):
    """Regroup key-sorted batches so that no run of equal (key, i, j) is torn: a run is at most
    two parts of `TREE` values long, give or take the unevenness of a hash."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = pa.concat_tables([held, t]) if held else t
        run = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
        change = np.flatnonzero((run[:, 1:] != run[:, :-1]).any(axis=0))
        if len(change):
            yield held.slice(0, change[-1] + 1).combine_chunks()
            held = held.slice(change[-1] + 1).combine_chunks()
    if held and held.num_rows:
        yield held.combine_chunks()


def links(values: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): pairs of ids that join all of ``values`` (id long, bits long; distinct bits) at
    most ``radius`` bits apart into their components."""
    keys = [F.lit(k).cast("long") * F.lit(1 << 32) +
            F.shiftrightunsigned("bits", s1).bitwiseAND(F.lit(m1)) * F.lit(1 << 16) +
            F.shiftrightunsigned("bits", s2).bitwiseAND(F.lit(m2))
            for k, ((s1, m1), (s2, m2)) in enumerate(combinations(blocks(radius), 2))] if radius + 2 >= 5 else \
        [F.lit(0).cast("long")]  # blocks of over 16 bits: one shard, split below like any large one
    spread = values.select("id", "bits", F.explode(F.array(*keys)).alias("key"))
    sizes = (spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select("key", F.ceil(F.col("n") / TREE).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    shared = (spread.join(sizes, "key").withColumn("part", part)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                      "part", "id", "bits"))

    def run(batches):
        for t in _complete_runs(batches):
            i, j, part = (t.column(c).to_numpy() for c in ("i", "j", "part"))
            key = np.stack([t.column("key").to_numpy(), i, j])
            number = np.concatenate(([0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))))
            bits = t.column("bits").to_numpy().view(np.uint64)
            ids = t.column("id").to_numpy()
            a, b = link_batch(number, bits, part == i, part == j, radius)
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    return (shared.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(run, "a long, b long").distinct())


def simhash_components(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    component_id is the smallest doc_id reachable over links of at most ``radius`` bits.
    Documents without words have fingerprint zero and link like others. A document with a
    null id gets the component of its fingerprint, null if nothing there has an id. Different
    texts under one id are documents of their own, not linked by the id. Repeated rows come out as often as they go in; an empty table gives no rows.
    """
    prints = cut(fingerprints(docs, shingle))
    # A class is known by its fingerprint, since different texts may share an id.
    classes = prints.groupBy("bits").agg(F.min("doc_id").alias("least"))
    found = connected_components(links(classes.filter("least is not null").select(F.col("bits").alias("id"), "bits"), radius))
    classes = classes.join(found, F.col("bits") == F.col("node"), "left")
    smallest = (classes.filter("component is not null").groupBy(F.col("component").alias("__component"))
                .agg(F.min("least").alias("smallest")))
    classes = (classes.join(smallest, F.col("component") == F.col("__component"), "left")
               .select(F.col("bits").alias("class"), F.coalesce("smallest", "least").alias("component_id")))
    return (prints.join(classes, F.col("bits") == F.col("class"))
            .select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"))


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    return simhash_components(read(spark, sf_dir, "documents"))
