"""Embedding near-duplicates with an inverted multi-index.

Vectors of a label that are equal collapse to one class first. Labels are indexed by size, so that a
large one has many cells and small ones few. Two independent codebooks, one
per half of the (unit) vectors, are fitted by k-means on a bounded sample (`SAMPLE` rows, told
by a hash of their id); their product grid has K x K cells, and every class is indexed
in its cell. Every class also searches: a multi-sequence traversal visits the cells by
ascending distance (sum of both halves' squared distances to the codewords). How many cells it
visits is calibrated: simulated partners of sampled vectors, placed exactly at the threshold in
random directions, must have their cell among the visited ones in `TARGET` of all cases;
nearer partners are met more often still. All vectors met are verified by their cosine in
double precision.

A cell with many members or visitors is split into parts of `PART` rows, and each part of
members meets each part of visitors in a task of its own; pairs are counted and joined into
local components there, never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.quantiles import small_table
from cadence.llm.common import cut, query, read
from cadence.llm.components import connected_components, join_labels

SAMPLE = 20_000
CELL = 256            # wanted members of a cell, for the size of a label's codebooks
MAX_CODEWORDS = 256
TARGET = 0.99         # share of simulated partners at the threshold that a search must meet
PART = 4096


def k_means(x: np.ndarray, k: int, rounds: int = 15, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = squared(x, centres).argmin(axis=1)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


class MultiIndex:
    """Codebooks of both halves and the number of cells that a search visits."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, target: float):
        x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.half = max(1, x.shape[1] // 2)
        distinct = len(np.unique(x, axis=0))
        self.k = min(k, distinct)
        self.books = [k_means(x[:, :self.half], self.k), k_means(x[:, self.half:], self.k)]
        rng = np.random.default_rng(5)
        x = x[:2000]
        u = rng.normal(size=x.shape)
        u -= (u * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(u, axis=1, keepdims=True)
        partner = threshold * x + np.sqrt(1 - threshold ** 2) * np.divide(u, size, out=np.zeros_like(u), where=size > 1e-9)
        first, second = self.distances(x)
        cell = self.cells(partner)
        rows = np.arange(len(x))
        reach = first[rows, cell // self.k] + second[rows, cell % self.k]
        rank = [int((a[:, None] + b[None, :] < r - 1e-12).sum()) + 1 for a, b, r in zip(first, second, reach)]
        self.visits = int(np.quantile(rank, target, method="higher"))

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(x[:, :self.half], self.books[0]), squared(x[:, self.half:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = self.distances(x)
        return first.argmin(axis=1) * self.k + second.argmin(axis=1)

    def traverse(self, x: np.ndarray) -> np.ndarray:
        """The ``visits`` nearest cells of each vector. The cell of the i-th nearest first and the
        j-th nearest second codeword has (i+1)(j+1) - 1 others before it, so only pairs with
        (i+1)(j+1) <= visits can be among them."""
        first, second = self.distances(x)
        o1, o2 = first.argsort(axis=1, kind="stable"), second.argsort(axis=1, kind="stable")
        pairs = np.array([(i, j) for i in range(self.k) for j in range(min(self.k, self.visits // (i + 1)))])
        i, j = pairs[:, 0], pairs[:, 1]
        sums = np.take_along_axis(first, o1, 1)[:, i] + np.take_along_axis(second, o2, 1)[:, j]
        best = sums.argsort(axis=1, kind="stable")[:, :self.visits]
        return np.take_along_axis(o1[:, i], best, 1) * self.k + np.take_along_axis(o2[:, j], best, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def meet(member: np.ndarray, visitor: np.ndarray, members: dict[str, np.ndarray], visitors: dict[str, np.ndarray], threshold: float):
    """(links of each visitor, links of each member, links (a, b) that join what is linked): all visitors against
    all members, given with their ids, numbers of copies, and own cells (visitors) and visited cells
    (members). A linked pair counts at its visitor; at its member only if that one does not visit the
    visitor's cell, where it counts the pair itself."""
    ids, where = np.unique(np.concatenate([members["id"], visitors["id"]]), return_inverse=True)
    m_at, v_at = where[:len(member)], where[len(member):]
    label, links, back = np.arange(len(ids)), np.zeros(len(visitor), np.int64), np.zeros(len(member), np.int64)
    m_norm = np.linalg.norm(member, axis=1)
    for i in range(0, len(visitor), 512):
        part, own, copies = visitor[i:i + 512], visitors["own"][i:i + 512], visitors["copies"][i:i + 512]
        near = part @ member.T / (np.linalg.norm(part, axis=1)[:, None] * m_norm) >= threshold
        near &= v_at[i:i + 512, None] != m_at
        links[i:i + 512] = near @ members["copies"]
        v, m = np.nonzero(near)
        for cell in np.unique(own[np.unique(v)]):
            unmet = ~(members["visits"] == cell).any(axis=1)
            if unmet.any():
                back[unmet] += near[own == cell][:, unmet].T @ copies[own == cell]
        label = join_labels(label, v_at[i:i + 512][v], m_at[m])
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return links, back, ids[moved], ids[label[moved]]


def _meetings(batches: Iterator[pa.RecordBatch], threshold: float):
    keys = ("group", "cell", "i", "j")
    held: list[pa.RecordBatch] = []

    def done(t: pa.Table):
        key = np.stack([t.column(c).to_numpy() for c in keys])
        edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for low, high in zip([0, *edge], [*edge, t.num_rows]):
            part = t.slice(low, high - low)
            is_member = part.column("member").to_numpy(zero_copy_only=False).astype(bool)
            if is_member.all() or not is_member.any():
                continue
            x = _matrix(part.column("vector").combine_chunks())
            column = {c: part.column(c).to_numpy() for c in ("id", "copies", "own")}
            members = {c: v[is_member] for c, v in column.items()}
            visits = part.column("visits").filter(pa.array(is_member)).combine_chunks()
            members["visits"] = visits.flatten().to_numpy().reshape(int(is_member.sum()), -1)
            visitors = {c: v[~is_member] for c, v in column.items()}
            links, back, a, b = meet(x[is_member], x[~is_member], members, visitors, threshold)
            counted = [(visitors["id"][links > 0], links[links > 0]), (members["id"][back > 0], back[back > 0])]
            n = sum(len(i) for i, _ in counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*[i for i, _ in counted], a])),
                 pa.array(np.concatenate([*[c for _, c in counted], np.zeros(len(a), np.int64)])),
                 pa.array(np.concatenate([np.zeros(n, np.int64), b]), mask=np.arange(n + len(a)) < n)],
                names=["id", "links", "other"])

    last = None
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column(c).to_numpy() for c in keys])
        change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        if held and tuple(key[:, 0]) != last:
            yield from done(pa.Table.from_batches(held))
            held = []
        if len(change):
            yield from done(pa.Table.from_batches([*held, b.slice(0, change[-1] + 1)]))
            held = [b.slice(change[-1] + 1)]
        else:
            held.append(b)
        last = tuple(key[:, -1])
    if held:
        yield from done(pa.Table.from_batches(held))


def _links(classes: DataFrame, k: int, threshold: float, target: float, sample_rows: int) -> DataFrame:
    """(id, links, other) of classes (group, id, copies, vector) that all have one dimension, with
    codebooks of ``k`` words."""
    # A threshold on the hash of the id leaves a little more than the sample, whatever the size.
    share = min(1.0, (1.1 * sample_rows + 100) / classes.count())
    few = classes.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    sample = np.array([r.vector for r in few.select("vector").limit(sample_rows).collect()], np.float64)
    index = MultiIndex(sample, k, threshold, target)

    def place(batches):
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(3))
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                visits = index.traverse(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * visits.shape[1], pa.int32()),
                                                 pa.array(visits.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(index.cells(x), pa.int32()), lists],
                                                 names=[*b.schema.names, "own", "visits"])

    placed = cut(classes.select("group", "id", "copies", "vector").mapInArrow(
        place, f"group long, id long, copies long, vector {dict(classes.dtypes)['vector']}, own int, visits array<int>"))
    members = placed.select("group", F.col("own").alias("cell"), "id", "copies", "vector", "own", "visits")
    visitors = placed.select("group", F.explode("visits").alias("cell"), "id", "copies", "vector", "own",
                             F.lit(None).cast("array<int>").alias("visits"))
    parts = (placed.groupBy("group", F.col("own").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("ni"))
             .join(visitors.groupBy("group", "cell").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("nj")), ["group", "cell"]))
    spot = F.xxhash64("id")
    both = (members.join(parts, ["group", "cell"])
            .withColumn("i", F.pmod(spot, F.col("ni")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nj") - 1))).withColumn("member", F.lit(1))
            .unionByName(visitors.join(parts, ["group", "cell"])
                         .withColumn("j", F.pmod(spot, F.col("nj")).cast("int"))
                         .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1))).withColumn("member", F.lit(0))))
    keys = ["group", "cell", "i", "j"]
    return (both.select(*keys, "member", "id", "copies", "vector", "own", "visits").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda batches: _meetings(batches, threshold), "id long, links long, other long"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, target: float = TARGET, sample_rows: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector of ``vectors`` (vec_id,
    embedding, label).

    Vectors are compared if their labels are equal and their lengths too. Null and zero
    vectors, vectors with a null or non-finite component, and rows with a null label or a null
    id link with nothing (a null id gets a null component and is not kept). Repeated rows count as
    vectors of their own. An empty table gives no rows.
    """
    # Floats travel as floats; all arithmetic is double.
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
                       F.col("embedding").cast(kind).alias("vector"))
    usable = _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # 96 bits of hash stand for (label, vector); -0.0 counts as 0.0.
    even = F.transform("vector", lambda c: c + F.lit(0.0))
    rows = v.select("vec_id", "vector", F.when(usable, F.size("vector")).alias("size"), F.xxhash64("label", F.size("vector")).alias("group"),
                    F.xxhash64("label", even).alias("h1"), F.hash("label", even).alias("h2"))
    classes = cut(rows.filter("size is not null").groupBy("size", "group", "h1", "h2")
                  .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")))
    # Lengths are filled up with zeros to a power of two, which leaves cosines as they are; a group's index has
    # as many cells as its own size asks for, again by powers of two. Few combinations can occur.
    words = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.sqrt(F.col("rows") / CELL), F.lit(1.0)))))
    groups = small_table(classes.groupBy("group").agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.col("group").alias("of"), F.least(words, F.lit(float(MAX_CODEWORDS))).cast("int").alias("k")))
    length = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("size").cast("double")))).cast("int")
    zero = F.lit(0.0).cast(kind[6:-1])
    tiers = cut(classes.join(groups, F.col("group") == F.col("of")).withColumn("length", length).select(
        "group", "id", "copies", "k", "length", F.concat("vector", F.array_repeat(zero, F.col("length") - F.col("size"))).alias("vector")))
    found = None
    for r in sorted(tiers.select("length", "k").distinct().collect()):
        part = _links(tiers.filter((F.col("length") == r.length) & (F.col("k") == r.k)), r.k, threshold, target, sample_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id long, links long, other long")
    found = cut(found.groupBy("id", "other").agg(F.sum("links").alias("links")))
    components = connected_components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "__id")
    done = (classes.join(counts, F.col("id") == F.col("__id"), "left").join(components, F.col("id") == F.col("node"), "left")
            .select(F.col("size").alias("s"), F.col("group").alias("g"), F.col("h1").alias("a"), F.col("h2").alias("b"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "id").alias("component")))
    narrow = rows.drop("vector")
    return (narrow.join(done, (F.col("size") == F.col("s")) & (F.col("group") == F.col("g")) & (F.col("h1") == F.col("a"))
                        & (F.col("h2") == F.col("b")), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


# Brute force: all pairs of a label. At the size of the oracle check a label is one cell, so the index
# meets every pair as well.
_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
r(node, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.seen FROM r JOIN l ON r.node = l.a)
SELECT v.vec_id, CAST((SELECT count(*) FROM l WHERE l.a = v.vec_id) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) c ON c.node = v.vec_id"""


@query("op10_embedding_dedup", _SQL)
def op10_embedding_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "embeddings"))
