"""The corpus pipeline: five stages, each on all that the last one kept.

Filtering stages return documents with the columns they came with; the last one returns token ids. ``run``
applies the stages to ``documents``. A stage is one operator of ``textlens.llm`` and its decision:
rejected documents go, one document of each near-duplicate group stays, documents that hold a benchmark
passage go, secrets are cut out of the text (and ``n_chars`` counted again), texts become ids.

Defined results: a null or empty text has too few words, so the first stage drops it; a later stage that is given one
keeps it (all texts without words are one near-duplicate group, hold no passage and no secret, and have no ids). Very long texts are
read whole. Of rows equal in id and text one stays, of a group the one with the smallest id (null ids last, ties by
content). Rows with equal ids and different texts are different documents. Empty tables give empty tables. Further columns are
carried along by all stages but the last and are never read; ``n_chars`` is renewed only if there is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.llm import decontaminate, near_dup, quality, queries, secrets
from textlens.llm.words import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a test item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    cleaned = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``round_trip`` says that they decode to its text."""
    return queries.token_ids(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_bpe", byte_bpe),
]
# Signatures, alignment and merges have no SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        # Later stages read their input several times, so what a stage keeps is written down first.
        docs = stage(spark, near_dup.saved(docs) if k else docs, sf_dir)
    return docs
