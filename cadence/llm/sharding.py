"""Sharding by a Feistel permutation of global row numbers.

Rows get dense numbers 0..N-1 in key order. A generalised Feistel network permutes
Z_a x Z_b with a*b >= N (a = ceil(sqrt N), b = ceil(N / a)); numbers that land at N or beyond
walk the cycle until they are inside. Place p of the permutation is shard p mod S, slot
p div S, so counts differ by one at most and slots have no gap, and anybody who knows
(N, S, seed) can compute the shard and slot of a row number, and back (`place_to_row`).

Everything is DataFrame expressions: one range sort of narrow rows for the numbers (written
once to the shared folder, see `global_rank`), then a projection.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.ranking import global_rank
from cadence.llm.common import query, read

PRIME = 2_147_483_647     # products of two residues stay inside a signed 64-bit integer
ROUNDS = 8
MAX_WALK = 64             # fewer than a points lie outside, so a longer walk has chance (1/a)**64


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """(addend, multiplier) of each round, from SHA-256 of the seed."""
    keys = []
    for i in range(rounds):
        h = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        keys.append((int.from_bytes(h[:8], "big") % PRIME, int.from_bytes(h[8:16], "big") % (PRIME - 1) + 1))
    return keys


def sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mixed(value: int, key: tuple[int, int]) -> int:
    u = (value % PRIME + key[0]) % PRIME
    return (u * u % PRIME) * key[1] % PRIME


def row_to_place(row: int, n: int, seed: int) -> int:
    """The permutation for one row number, outside Spark."""
    a, b = sides(n)
    x = row
    while True:
        left, right = divmod(x, b)
        for i, k in enumerate(round_keys(seed)):
            if i % 2 == 0:
                left = (left + _mixed(right, k)) % a
            else:
                right = (right + _mixed(left, k)) % b
        x = left * b + right
        if x < n:
            return x


def place_to_row(place: int, n: int, seed: int) -> int:
    """Inverse of `row_to_place`: which row number stands at ``place``."""
    a, b = sides(n)
    x = place
    while True:
        left, right = divmod(x, b)
        for i, k in reversed(list(enumerate(round_keys(seed)))):
            if i % 2 == 0:
                left = (left - _mixed(right, k)) % a
            else:
                right = (right - _mixed(left, k)) % b
        x = left * b + right
        if x < n:
            return x


def feistel_place(row: Column, n: int, seed: int) -> Column:
    """`row_to_place` as a column expression."""
    a, b = sides(n)
    rounds = F.array(*[F.struct(F.lit(i % 2).alias("side"), F.lit(add).cast("long").alias("add"),
                                F.lit(mul).cast("long").alias("mul"))
                       for i, (add, mul) in enumerate(round_keys(seed))])

    def mixed(v: Column, k: Column) -> Column:
        u = (v % PRIME + k["add"]) % PRIME
        return (u * u) % PRIME * k["mul"] % PRIME

    def one_round(s: Column, k: Column) -> Column:
        even = k["side"] == 0
        return F.struct(F.when(even, (s["l"] + mixed(s["r"], k)) % a).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise((s["r"] + mixed(s["l"], k)) % b).alias("r"))

    def network(x: Column) -> Column:
        start = F.struct(F.call_function("div", x, F.lit(b).cast("long")).alias("l"), (x % b).cast("long").alias("r"))
        return F.aggregate(rounds, start, one_round, lambda s: s["l"] * b + s["r"])

    walked = F.aggregate(F.sequence(F.lit(2), F.lit(MAX_WALK)), network(row),
                         lambda x, _: F.when(x < n, x).otherwise(network(x)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def feistel_shards(df: DataFrame, order: list[str], shards: int, seed: int = 42) -> DataFrame:
    """``df`` with columns row_number, shard and slot (law `rows`).

    Numbers follow ``order`` (ascending, nulls first); rows equal in ``order`` take
    consecutive numbers. Clashing columns row_number, shard and slot are replaced. An
    empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    numbered = global_rank(df.drop("row_number", "shard", "slot"), order, "row_number")
    n = numbered.count()
    placed = numbered.withColumn("__place", feistel_place(F.col("row_number"), max(n, 1), seed))
    return (placed.withColumn("shard", (F.col("__place") % shards).cast("int"))
            .withColumn("slot", F.call_function("div", F.col("__place"), F.lit(shards).cast("long")))
            .drop("__place"))


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """Shard and slot of every document by the `rows` law, with the size and checksum of its text.

    Null text: size 8, checksum of the empty text. Null ids come first in the numbering.
    Only the id, size and checksum are moved, never the text.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         (F.octet_length(body).cast("long") + 8).alias("size"),
                         F.crc32(body).cast("long").alias("text_crc32"))
    return feistel_shards(narrow, ["doc_id", "size", "text_crc32"], shards, seed)


@query("op5_sharding")
def op5_sharding(spark, sf_dir):
    out = shard_documents(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_number")
