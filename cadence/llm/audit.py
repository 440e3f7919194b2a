"""Interaction audit of quality filters by count-weighted decision diagrams.

Every document gets a failure mask, one bit a filter, by DataFrame expressions; documents
collapse to counts per (part, mask) before anything meets in one task, so a part is at most
2**filters rows, however many documents it has. A task then builds one decision diagram per
part: a level per filter, in the order the filters are applied, edges for pass and fail, and the
counts (documents, good ones, toxic ones) of a mask at the end of its path. Every node carries
the weight below it. Orders follow one another by swaps of adjacent levels (each order differs
from the one before by one swap), and the all-pass path of a diagram holds the steps of its
order: the weight of the pass edge is what a filter keeps, that of the fail edge what it removes.

Nulls, ties and odd tables: a null text is empty, a null source is the part of the empty string; a
document without an id has no smaller ids and makes no other one a copy; rows that repeat an id
and a text don't make each other copies; an id with several label rows is good (toxic) if one of
them says so; labels without a document count nowhere; an empty table has no parts and gives no
rows. Extra columns of any name are ignored. Texts are read whole, and move no further than the task that
reads them.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import SPACE, query, read

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "[#$%&*|]"
COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails each filter that looks at the text alone: too few words, too few distinct
    words, too many capitals, symbols."""
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    capitals = F.octet_length(text) - F.octet_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    n = F.size(words).cast("long")
    return [n < MIN_WORDS, 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * n,
            100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(text).cast("long"), text.rlike(SYMBOLS)]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part by the filters they fail; bit i of the mask
    stands for filter i. The last filter fails copies: documents whose text a smaller id has too.

    A copy is told without bringing the holders of a text together: holders are counted per (text,
    part) with partial aggregation, those with the least id apart, and a text has one row for each part."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("text")))), F.lit(0))
    rows = (docs.select(F.coalesce("source", F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("bits"))
            .groupBy("part", "doc_id", "digest").agg(F.max("bits").alias("bits"), F.count(F.lit(1)).alias("n")))
    judged = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    # Rows without an id meet no label; a key made from the text spreads them.
    key = F.coalesce(F.col("doc_id"), F.xxhash64("digest"))
    rows = (rows.withColumn("__key", key)
            .join(judged, (F.col("__key") == F.col("labelled")) & F.col("doc_id").isNotNull(), "left")
            .select("part", "doc_id", "digest", "bits", "n", F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"),
                    F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic")))
    least = F.min_by(F.struct(*COUNTS), "doc_id")
    held = rows.groupBy("digest", "part").agg(
        F.max("bits").alias("bits"), F.min("doc_id").alias("least"), least.alias("at_least"),
        *[F.sum(c).alias(c) for c in COUNTS],
        *[F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(0)).alias(f"no_id_{c}") for c in COUNTS])
    first = F.min("least").over(Window.partitionBy("digest"))
    original = {c: F.col(f"no_id_{c}") + F.when(F.col("least") == F.col("first"), F.col(f"at_least.{c}")).otherwise(0)
                for c in COUNTS}
    copy_bit = 1 << (len(FILTERS) - 1)
    both = F.array(F.struct(F.col("bits").alias("mask"), *[original[c].alias(c) for c in COUNTS]),
                   F.struct((F.col("bits") + copy_bit).alias("mask"), *[(F.col(c) - original[c]).alias(c) for c in COUNTS]))
    return (held.withColumn("first", first).select("part", F.explode(both).alias("m")).select("part", "m.*").where("n > 0")
            .groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]))


class Diagram:
    """A decision diagram over ``order`` (filters, first level first). A node is a number with a pass
    child and a fail child; equal nodes of a level are one. Nodes of the last level point to count
    vectors, and a branch without any document is node 0 on every level."""

    def __init__(self, counts: dict[int, tuple], order: tuple[int, ...]):
        self.order = list(order)
        zero = tuple(0 for _ in next(iter(counts.values())))
        self.weights = [zero]                       # of all documents below a node
        self.children = [(0, 0)]
        self.nodes = [{} for _ in range(len(order) + 1)]  # level: {children, or counts at the end: node}
        self.root = self._build(counts, 0)

    def _build(self, counts: dict[int, tuple], level: int) -> int:
        if not counts:
            return 0
        if level == len(self.order):
            return self._add(level, *counts.values(), (0, 0), *counts.values())
        bit = 1 << self.order[level]
        return self._node(level, self._build({m: c for m, c in counts.items() if not m & bit}, level + 1),
                          self._build({m: c for m, c in counts.items() if m & bit}, level + 1))

    def _node(self, level: int, low: int, high: int) -> int:
        if not low and not high:
            return 0
        weight = tuple(a + b for a, b in zip(self.weights[low], self.weights[high]))
        return self._add(level, (low, high), (low, high), weight)

    def _add(self, level: int, name: tuple, children: tuple, weight: tuple) -> int:
        if name not in self.nodes[level]:
            self.nodes[level][name] = len(self.children)
            self.children.append(children)
            self.weights.append(weight)
        return self.nodes[level][name]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it: nodes of the upper level keep their
        numbers and weights and get new children, so that nothing above or further below changes."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        upper, self.nodes[level], self.nodes[level + 1] = self.nodes[level], {}, {}
        for (low, high), node in upper.items():
            (ll, lh), (hl, hh) = self.children[low], self.children[high]
            now = (self._node(level + 1, ll, hl), self._node(level + 1, lh, hh))
            self.children[node] = now
            self.nodes[level][now] = node

    def steps(self) -> list[tuple[tuple, tuple]]:
        """(kept, removed) of every step: the two edges of each node on the all-pass path."""
        node, out = self.root, []
        for _ in self.order:
            low, high = self.children[node]
            out.append((self.weights[low], self.weights[high]))
            node = low
        return out

    def only(self, filter_: int) -> tuple:
        """Counts of the mask that fails this filter alone: the path with one fail edge."""
        node = self.root
        for f in self.order:
            node = self.children[node][f == filter_]
        return self.weights[node]


def adjacent_swaps(n: int):
    """Levels to swap, one after the other, so that all n! orders appear, each once: the last
    element walks through the others, which take their own next swap at each of its ends."""
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        level = next(inner, None)
        if level is None:
            return
        yield level + 1 if down else level
        down = not down


def audit_part(counts: dict[int, tuple], n_filters: int) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all
    orders and steps from {mask: (n, good, toxic)}."""
    diagram = Diagram(counts, tuple(range(n_filters)))
    orders = {tuple(diagram.order): diagram.steps()}
    for level in adjacent_swaps(n_filters):
        diagram.swap(level)
        orders[tuple(diagram.order)] = diagram.steps()
    assert len(orders) == math.factorial(n_filters)
    fails, shapley = [0] * n_filters, [0] * n_filters
    for order, steps in orders.items():
        fails[order[0]] = steps[0][1][0]  # as the first one, a filter removes all that fail it
        for f, (_, removed) in zip(order, steps):
            shapley[f] += removed[0]
    alone = [diagram.only(f)[0] for f in range(n_filters)]
    return [(order, k + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], shapley[f])
            for order, steps in orders.items() for k, (f, (kept, removed)) in enumerate(zip(order, steps))]


def interaction_audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of ``names`` and step from `failure_counts`-like rows (part, mask, n,
    good, toxic), several rows of a mask are added up."""
    numbers = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    size = len(names)

    def audit(rows: pd.DataFrame) -> pd.DataFrame:
        table = {int(m): tuple(int(x) for x in c) for m, *c in rows[["mask", *COUNTS]].itertuples(index=False)}
        out = pd.DataFrame(audit_part(table, size), columns=["order", "step", *numbers])
        out.insert(0, "filter_order", ["".join(names[f] for f in o) for o in out.pop("order")])
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in numbers)
    whole = counts.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])
    return whole.groupBy("part").applyInPandas(audit, schema)


_SPACES = r"[^\x20\x09-\x0D]+"

OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_SPACES}') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS mask,
        coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(name, bit)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
        [0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit] AS earlier,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.name, b.name, c.name, d.name, e.name])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, earlier[step] AS earlier, bits[step] AS bit
      FROM o, range(1, 6) AS t(step)),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


@query("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark, sf_dir):
    return interaction_audit(failure_counts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))
