"""Registered queries of the operators: name to (query, oracle SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.llm import (
    bpe, clustering, decontaminate, html_text, lm, near_dup, quality, ranking, secrets, sharding, substring, toxicity, variants,
)
from textlens.llm.words import table

RANKS = "byte_bpe_50k.tiktoken"


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.judge(docs).drop("text")


def op2_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("held_out", lm.held_out())
    scored = lm.score(docs, F.col("held_out"), ["doc_id", "text"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard_rows(sharding.document_keys(table(spark, sf, "documents")))
    return placed.drop("row_number").withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = substring.remove_repeats(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


def op5_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    classes = near_dup.Groups(table(spark, sf, "documents").select("doc_id", "text")).classes()
    return classes.select(F.col("id").alias("doc_id"), "class_id", (F.col("id") == F.col("class_id")).alias("kept"), "group_size")


def tokenizer(docs: DataFrame) -> bpe.ByteBPE:
    """The public byte-level tokenizer, with the frequent words of ``docs``."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.ByteBPE(ranks, public_tokenizers.PATTERN).with_frequent(docs)


def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.add_ids(docs, tokenizer(docs)).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def token_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of documents."""
    return bpe.add_ids(docs.select("doc_id", "text"), tokenizer(docs)).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


def op7_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    scanned = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))
    count = lambda rank: F.size(F.filter("base_spans", lambda s: s["rank"] == rank)).cast("bigint")
    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    done = html_text.main_text(table(spark, sf, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    judge = toxicity.fit(docs, table(spark, sf, "labels"), ~toxicity.held_out())
    scored = judge.score(docs).withColumn("held_out", toxicity.held_out())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.cluster(table(spark, sf, "embeddings")).drop("compared")


def op12_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ranker = ranking.fit(docs, table(spark, sf, "labels"), ~ranking.held_out())
    scored = ranker.score(docs).withColumn("held_out", ranking.held_out())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= ranking.THRESHOLD).cast("int").alias("predicted"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group_variants(table(spark, sf, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_quality_rules": (op1_quality_rules, quality.oracle_sql()),
    "op2_lm_scoring": (op2_lm_scoring, None),
    "op3_sharding": (op3_sharding, sharding.oracle_sql()),
    "op4_substring_dedup": (op4_substring_dedup, substring.oracle_sql()),
    "op5_near_dedup": (op5_near_dedup, near_dup.oracle_sql()),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_secret_scans": (op7_secret_scans, None),
    "op8_html_extraction": (op8_html_extraction, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_decontamination": (op10_decontamination, None),
    "op11_centroid_clustering": (op11_centroid_clustering, clustering.oracle_sql()),
    "op12_quality_classifier": (op12_quality_classifier, None),
    "op13_spelling_variants": (op13_spelling_variants, variants.oracle_sql()),
}
