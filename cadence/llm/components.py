"""Connected components of a link table, by alternating large-star and small-star steps.

Links stay distributed; every round is two grouped minima and two joins, written to the
shared checkpoint folder. Rounds grow with the logarithm of the longest path, not with it.
`join_labels` is the same for the links that a task has met by itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import cut


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long), component being the
    smallest node reachable. Self-links, repeated links and null ends are ignored."""
    e = cut(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            .filter("lo < hi").distinct())
    now, before = _state(e), None
    while now != before and now[0]:
        # Large star: every neighbour above u hangs on the smallest node next to u (u included).
        both = e.unionByName(e.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy(F.col("lo").alias("u")).agg(F.min("hi").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (e.join(least, F.col("lo") == F.col("u")).select(F.col("m").alias("lo"), "hi")
                 .filter("lo < hi").distinct())
        # Small star: every neighbour below u, and u, hang on the smallest of them.
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo != m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        e = cut(small.unionByName(low.select(F.col("m").alias("lo"), "hi")).distinct())
        now, before = _state(e), now
    # A star forest now: every node but a component's smallest has that one as its only neighbour.
    return (e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct())


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the classes of a[i] and b[i], classes being numbered by their smallest member."""
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
