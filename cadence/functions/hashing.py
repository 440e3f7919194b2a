"""Deterministic hash buckets.

``md5(key || ':' || seed)``, first 8 hex digits as an unsigned 32-bit integer, modulo the
bucket count. Stateless per row: no shuffle, stable under repartitioning and retries, and
reproducible in DuckDB as ``('0x' || substr(md5(k || ':42'), 1, 8))::BIGINT % 100``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(key: Column, seed: int = 42) -> Column:
    h = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)
    return F.conv(h, 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int = 100, seed: int = 42) -> Column:
    return (hash32(key, seed) % F.lit(buckets)).cast("int")


def hash_fraction(key: Column, seed: int = 42) -> Column:
    """Uniform value in [0, 1) from the 32-bit hash."""
    return hash32(key, seed) / F.lit(4294967296.0)


def row_key(columns: list[str]) -> Column:
    """Content key for tables without one: xxhash64 of all columns."""
    return F.xxhash64(*[F.col(c) for c in columns])
