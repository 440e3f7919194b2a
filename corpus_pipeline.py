"""Corpus pipeline over the documents table: language, near-duplicates, benchmark copies, personal
data, packing. Each stage is one operator of `cadence.llm` on all that the stage before kept.

Every stage takes documents with any null columns, repeated rows and clashing extra columns;
all but the last return the columns they got. An empty table passes through.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadence.llm.common import read, shared_folder  # noqa: E402
from cadence.llm.decontaminate import contaminated  # noqa: E402
from cadence.llm.language import UNKNOWN, fit, predict  # noqa: E402
from cadence.llm.packing import pack_documents, tokenizer_path  # noqa: E402
from cadence.llm.pii import redact  # noqa: E402
from cadence.llm.simhash import simhash_components  # noqa: E402
from cadence.session import ship_package  # noqa: E402

#: No stage can be expressed in DuckDB SQL (trained model, XXH64 bits, alignments, tokenizer).
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those that the operator calls `und` go, which are null
    texts and texts without a letter. Short texts have low scores and stay. The model is learned
    from the labelled documents of the stage's own input; without any label no language can be
    told, and the same texts go."""
    ship_package(spark)
    model = fit(docs.select("doc_id", "text", "lang"))
    if not model.families:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = docs.withColumn("__told", predict(model))
    return judged.filter(F.col("__told.lang_pred") != UNKNOWN).drop("__told")


def _keyed(docs: DataFrame) -> DataFrame:
    """With __key, the id, or for a null id a large number made from the text; and __one, a hash of
    key and text, since different texts may share an id."""
    made = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), made))
    return keyed.withColumn("__one", F.xxhash64("__key", "text"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id, once if rows repeat it.
    Different texts under one id are documents of their own.
    Documents without an id come after all others; equal texts among them are one document."""
    ship_package(spark)
    keyed = _keyed(docs)
    groups = simhash_components(keyed.select(F.col("__one").alias("doc_id"), "text")).distinct()
    ids = keyed.groupBy("__one").agg(F.min("__key").alias("__key"))
    first = (groups.join(ids, F.col("doc_id") == F.col("__one")).groupBy("component_id")
             .agg(F.min(F.struct("__key", "__one")).alias("least")).select(F.col("least.__one").alias("__first")))
    again = F.row_number().over(Window.partitionBy("__one").orderBy("__key"))
    return (keyed.join(first, F.col("__one") == F.col("__first"), "left_semi")
            .withColumn("__row", again).filter("__row = 1").drop("__row", "__key", "__one"))


def without_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    ship_package(spark)
    keyed = _keyed(docs)
    found = contaminated(keyed.select(F.col("__one").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    hit = found.select(F.col("doc_id").alias("__hit")).distinct()
    return keyed.join(hit, F.col("__one") == F.col("__hit"), "left_anti").drop("__key", "__one")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by the kind in brackets."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in the training sequences."""
    ship_package(spark)
    return pack_documents(docs, tokenizer_path())


STAGES = [("language_id", known_language), ("simhash_dedup", without_near_duplicates),
          ("decontamination", without_benchmark_copies), ("pii", without_personal_data), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
