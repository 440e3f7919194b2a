"""Documents in blocks that several passes can meet again without moving the text.

Texts are written once to the shared folder as a table bucketed by block number; a block is a
run of rows of one task, at most a stated number of bytes of text or one document longer than
that. A pass
groups the table by block, and answers that other stages computed for a block are
cogrouped with it: the bucketing spares the shuffle of the text each time, and since blocks are
data, not tasks, a lost executor changes nothing.

Passes ask questions about keys (hashes). A block sends its sorted keys to key buckets, one
binary row per bucket; the bucket answers in the same order, so an answer needs no keys. Blocks
and buckets grow with the root of the text, so that such a row holds hundreds of keys at any
size (8 MB blocks up to 44 GB of text, 400 MB blocks for 100 TB). There are four key buckets to a
partition, which evens out what hashing gives a task.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import shared_folder

BLOCK_BYTES = 8 << 20      # at least
ROW_KEYS = 1600            # the square of a block's bytes for each byte of text, at least
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the result."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def layout(docs: DataFrame) -> tuple[int, int, int]:
    """(bytes of a block, buckets of blocks, buckets of keys): a bucket of blocks stands for two
    blocks of text, or less where the session asks for more partitions."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    block = max(BLOCK_BYTES, math.isqrt(ROW_KEYS * total))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * block)))
    return block, parts, 4 * parts


def write_blocks(docs: DataFrame, block_bytes: int, buckets: int) -> DataFrame:
    """``docs`` (with a text column) with a column block, read back from the written table."""
    at = docs.columns.index("text")

    def number(batches):
        from pyspark import TaskContext
        block, held = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            size = np.diff(np.frombuffer(b.column(at).buffers()[1], np.int32, b.num_rows + 1, b.column(at).offset * 4)) \
                if b.column(at).type == pa.string() else np.array([len(t.as_buffer()) for t in b.column(at)])
            of = np.empty(b.num_rows, np.int64)
            for i, n in enumerate(size.tolist()):
                if held and held + n > block_bytes:
                    block, held = block + 1, 0
                of[i] = block
                held += n
            yield pa.RecordBatch.from_arrays([pa.array(of), *b.columns], names=["block", *b.schema.names])

    schema = "block long, " + ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return write_bucketed(docs.mapInArrow(number, schema), buckets)


def write_bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (with a column block), written once as a table bucketed by block and read back."""
    spark = rows.sparkSession
    name = f"cadence_blocks_{uuid.uuid4().hex}"
    (rows.write.bucketBy(buckets, "block").option("path", shared_folder(spark, "blocks"))
     .option("compression", "zstd").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay, and so does what was read from it
    return table


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of ``keys`` by bucket, then key; first place of every bucket and the end)."""
    order = np.argsort(keys)
    # Numbers of 16 bits are sorted by radix, in one go.
    bucket = (keys[order] % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    within = np.argsort(bucket, kind="stable")
    return order[within], np.searchsorted(bucket[within], np.arange(buckets + 1))
