"""Sources, sinks, projections and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens import SentimentAnalyzer
from textlens.functions import text as X
from textlens.operators.sentences import add_sentence_count, repartition_by_rows, add_sentences
from textlens.session import shared_path
from textlens.sources.readers import inline_table as inline, read_csv, read_parquet
from textlens.sources.sinks import materialise, read_runs
from workload.common import (
    SQL_LEXICON, documents, lexicon, sql_sentences, sql_tokens, table,
)

PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/documents.parquet").select("doc_id", "lang", "source", "n_chars")


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "part-csv")
    table(spark, sf, "part").write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, PART_SCHEMA)


def inline_table(spark: SparkSession, sf: str) -> DataFrame:
    names = inline(spark, LANGUAGE_NAMES, "lang string, language string")
    docs = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("documents"))
    return docs.join(F.broadcast(names), "lang", "left").select("lang", "language", "documents")


LANGUAGE_NAMES = [("de", "German"), ("en", "English"), ("es", "Spanish")]


def write_read_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    scored = docs.select("doc_id", lexicon().score(F.col("text")).alias("doc_sentiments"))
    return materialise(scored)


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """A run that succeeds and one that fails; both leave a record."""
    path = shared_path(spark, "runs")
    analyzer = SentimentAnalyzer(
        spark, scorers={"vader": lexicon()}, run_log_path=path, materialise_result=True
    )
    analyzer.trigger_SentimentInference(documents(spark, sf), "vader", sentParse=False)
    try:
        analyzer.trigger_SentimentInference(documents(spark, sf), "unheard-of", binarize=True)
    except ValueError:
        pass
    return read_runs(spark, path).select(
        F.col("parameters")["model_name"].alias("model_name"),
        F.col("parameters")["binarize"].alias("binarize"),
        F.col("metrics")["rows"].alias("scored_rows"),
        "success",
        F.col("error").isNotNull().alias("has_error"),
    )


def project(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", "text")


def concat_text(spark: SparkSession, sf: str) -> DataFrame:
    """Role stands in for the title; it is null for system turns and empty for users."""
    role = F.col("role")
    title = F.when(role == "assistant", role).when(role == "user", F.lit(""))
    turns = table(spark, sf, "conversations").withColumn("title", title)
    return turns.select("conv_id", "turn", X.concat_text("title", "text").alias("text"))


def _holey_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts whose cheap prices are null and whose small sizes have an empty type."""
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", "p_name",
        F.when(F.col("p_size") > 10, F.col("p_type")).otherwise("").alias("p_type"),
        F.when(F.col("p_size") < 40, F.col("p_brand")).alias("p_brand"),
        "p_size",
    )


SQL_HOLEY = """holey AS (SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_type ELSE '' END AS p_type,
    CASE WHEN p_size < 40 THEN p_brand END AS p_brand, p_size FROM part)"""


def _sql_fill(c: str) -> str:
    return f"coalesce(nullif({c}::VARCHAR, ''), 'None')"


def fill_placeholder(spark: SparkSession, sf: str) -> DataFrame:
    p = _holey_parts(spark, sf)
    return p.select("p_partkey", *[X.placeholder(c).alias(c) for c in ("p_type", "p_brand")])


def composite_label(spark: SparkSession, sf: str) -> DataFrame:
    p = _holey_parts(spark, sf)
    return p.select("p_partkey", X.composite_label("p_brand", "p_type", "p_size").alias("combined_labels"))


def input_text(spark: SparkSession, sf: str) -> DataFrame:
    p = _holey_parts(spark, sf)
    return p.select("p_partkey", X.input_text("p_name", "p_type", "p_size").alias("input_text"))


def repartition_plan(spark: SparkSession, sf: str) -> DataFrame:
    docs = repartition_by_rows(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    return add_sentence_count(add_sentences(docs, "text")).select("doc_id", "sentence_count")


SQL_PARTS = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"

QUERIES = {
    "scan_parquet": (scan_parquet, "SELECT doc_id, lang, source, n_chars FROM documents"),
    "scan_csv": (scan_csv, SQL_PARTS),
    "inline_table": (
        inline_table,
        """SELECT lang, CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' END
           AS language, count(*)::BIGINT AS documents FROM documents GROUP BY lang""",
    ),
    "write_read_scores": (
        write_read_scores,
        f"""WITH {SQL_LEXICON}, tok AS (SELECT doc_id, unnest({sql_tokens()}) AS token FROM documents),
            hits AS (SELECT doc_id, sum(valence) AS x FROM tok JOIN lex USING (token) GROUP BY doc_id)
            SELECT d.doc_id, round(coalesce(x, 0) / sqrt(coalesce(x, 0) * coalesce(x, 0) + 15), 4)::DOUBLE
            AS doc_sentiments FROM documents d LEFT JOIN hits USING (doc_id)""",
    ),
    "run_log": (
        run_log,
        """SELECT 'vader' AS model_name, 'False' AS binarize, count(*)::DOUBLE AS scored_rows,
           1.0::DOUBLE AS success, false AS has_error FROM documents
           UNION ALL SELECT 'unheard-of', 'True', NULL, 0.0, true""",
    ),
    "project": (project, "SELECT doc_id, text FROM documents"),
    "concat_text": (
        concat_text,
        """SELECT conv_id, turn, concat_ws(' . ', CASE role WHEN 'assistant' THEN role WHEN 'user' THEN '' END, text)
           AS text FROM conversations""",
    ),
    "fill_placeholder": (
        fill_placeholder,
        f"WITH {SQL_HOLEY} SELECT p_partkey, {_sql_fill('p_type')} AS p_type, {_sql_fill('p_brand')} AS p_brand FROM holey",
    ),
    "composite_label": (
        composite_label,
        f"WITH {SQL_HOLEY} SELECT p_partkey, {' || chr(124) || chr(124) || chr(124) || '.join(map(_sql_fill, ['p_brand', 'p_type', 'p_size']))} AS combined_labels FROM holey",
    ),
    "input_text": (
        input_text,
        f"WITH {SQL_HOLEY} SELECT p_partkey, {' || chr(32) || '.join(map(_sql_fill, ['p_name', 'p_type', 'p_size']))} AS input_text FROM holey",
    ),
    "repartition_plan": (
        repartition_plan,
        f"SELECT doc_id, len({sql_sentences()})::BIGINT AS sentence_count FROM documents",
    ),
}
