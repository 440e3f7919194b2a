"""Imports every operator module, so that its query registers in `common.QUERIES`."""

import importlib

from cadence.llm.common import ORACLE, QUERIES

MODULES = ("audit", "conversations", "decontaminate", "embeddings", "fertility", "language", "packing", "pii", "scoring", "sharding", "simhash", "suffixes", "warc")

# op7 and op10 have DuckDB SQL, beside their queries. The other eight have none: their hashes (XXH64,
# CRC-32), tokenizer, trained models, alignments, bootstrapped patterns and byte spans have no DuckDB
# counterpart; tests/llm holds each against a brute-force version or held-out accuracy.


def load() -> tuple[dict, dict]:
    for m in MODULES:
        importlib.import_module(f"cadence.llm.{m}")
    return QUERIES, ORACLE
