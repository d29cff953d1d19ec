"""Model scoring with the marker-word stand-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens import score_sentiment
from textlens.functions import scores as S
from textlens.operators.scoring import map_labels, model_logits
from textlens.operators.sentences import DOC_SCORE_COLUMN
from textlens.plans.sentiment import ensemble_score, sentiment_class
from workload.common import (
    SENTIMENT, SENTIMENT_MARKERS, SQL_LEXICON, SQL_ROBERTA, documents, lexicon, rounded, sql_argmax,
    sql_binarize, sql_sentences, sql_signed, sql_softmax, sql_tokens,
)
from workload.text import exploded_scores

CLASSES = len(SENTIMENT_MARKERS)


def _logits(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    docs = documents(spark, sf, *columns)
    return docs.select("doc_id", *columns, SENTIMENT.column(F.col("text")).alias("logits"))


def _probs(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _logits(spark, sf, *columns).withColumn("probs", S.softmax(F.col("logits"), CLASSES))


def model_sentence_signed(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_sentiment(documents(spark, sf), "text", SENTIMENT, score_mode="label_signed")
    return exploded_scores(scored, ["doc_id"]).withColumn("score", rounded("score"))


def model_sentence_prob_diff(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_sentiment(documents(spark, sf), "text", SENTIMENT, score_mode="prob_diff")
    return exploded_scores(scored, ["doc_id"]).withColumn("score", rounded("score"))


def model_sentence_by_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same scores with sentences, not documents, spread over the cluster."""
    scored = score_sentiment(
        documents(spark, sf), "text", SENTIMENT, score_mode="prob_diff", keys=["doc_id"], by_rows=True
    )
    return exploded_scores(scored, ["doc_id"]).withColumn("score", rounded("score"))


def model_doc_signed(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_sentiment(documents(spark, sf), "text", SENTIMENT, level="document")
    return scored.select("doc_id", rounded(DOC_SCORE_COLUMN).alias(DOC_SCORE_COLUMN))


LABEL_ROWS = [(model, raw, label) for model, entries in S.LABEL_MAP.items() for raw, label in entries.items()]
MODEL_BY_LANG = {"en": "roberta", "de": "albert"}


def label_map(spark: SparkSession, sf: str) -> DataFrame:
    """Raw label of each document under a model chosen by language; some are unmapped."""
    model = F.when(F.col("lang") == "en", "roberta").when(F.col("lang") == "de", "ALBERT").otherwise("distilbert")
    raw = S.pick_label(SENTIMENT.labels, S.argmax(F.col("logits")))
    rows = _logits(spark, sf, "lang").select("doc_id", model.alias("model"), raw.alias("raw_label"))
    entries = spark.createDataFrame(LABEL_ROWS, "model string, raw_label string, label string")
    return map_labels(rows, entries, "model", "raw_label").select("doc_id", "model", "raw_label", "label")


def signed_polarity(spark: SparkSession, sf: str) -> DataFrame:
    probs = _probs(spark, sf)
    label = S.canonical_label("roberta", S.pick_label(SENTIMENT.labels, S.argmax(F.col("probs"))))
    rows = probs.select("doc_id", label.alias("label"), F.array_max("probs").alias("confidence"))
    signed = S.signed_polarity(F.col("label"), F.col("confidence"))
    return rows.select("doc_id", "label", rounded("confidence").alias("confidence"), rounded(signed).alias("score"))


def softmax_probs(spark: SparkSession, sf: str) -> DataFrame:
    probs = _probs(spark, sf)
    return probs.select("doc_id", *[rounded(F.get("probs", F.lit(i))).alias(f"p{i}") for i in range(CLASSES)])


def prob_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _probs(spark, sf).select("doc_id", rounded(S.polarity_difference(F.col("probs"))).alias("score"))


# Scores that no lexicon gives, as rows of their own.
EDGES = [(-1, None), (-2, float("nan")), (-3, 0.0), (-4, -0.0), (-5, float("inf")), (-6, -1e-300)]


def binarize(spark: SparkSession, sf: str) -> DataFrame:
    """Signs of lexicon scores, and of scores at the edges."""
    rows = documents(spark, sf).select("doc_id", lexicon().score(F.col("text")).alias("score"))
    rows = rows.unionByName(spark.createDataFrame(EDGES, "doc_id bigint, score double"))
    return rows.select("doc_id", S.binarize(F.col("score")).alias("sign"))


def argmax_label(spark: SparkSession, sf: str) -> DataFrame:
    class_id = S.argmax(F.col("logits"))
    return _logits(spark, sf).select(
        "doc_id", class_id.alias("class_id"), S.pick_label(SENTIMENT.labels, class_id).alias("label")
    )


def udf_scorer(spark: SparkSession, sf: str) -> DataFrame:
    """Logits from the Arrow UDF (the other queries use the column form of the same rule)."""
    docs = documents(spark, sf).select("doc_id", model_logits(SENTIMENT, F.col("text")).alias("logits"))
    return docs.select("doc_id", *[rounded(F.get("logits", F.lit(i))).alias(f"l{i}") for i in range(CLASSES)])


def batch_invariance(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    for mode, call_size in (("dynamic", 7), ("sequential", 100), ("none", None)):
        docs = score_sentiment(
            docs, "text", SENTIMENT, level="document", score_mode="prob_diff", batching=mode, call_size=call_size
        )
        docs = docs.withColumnRenamed(DOC_SCORE_COLUMN, f"{mode}_score")
    return docs.select("doc_id", *[rounded(f"{m}_score").alias(f"{m}_score") for m in ("dynamic", "sequential", "none")])


def ensemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = _probs(spark, sf, "text").select(
        "doc_id", S.polarity_difference(F.col("probs")).alias("model_score"),
        lexicon().score(F.col("text")).alias("lexicon_score"),
    )
    scored = ensemble_score(rows, ["model_score", "lexicon_score"])
    return scored.select("doc_id", rounded("ensemble_score").alias("ensemble_score"))


def multiclass_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return _logits(spark, sf).select(
        "doc_id", sentiment_class(F.col("logits"), SENTIMENT.labels, "roberta").alias("sentiment")
    )


_PROBS = [f"p{i}" for i in range(CLASSES)]
_TOP = f"greatest({', '.join(_PROBS)})"
_CLASS = sql_argmax(_PROBS)
_DOCS = sql_softmax("documents", "doc_id, lang", SENTIMENT_MARKERS)
_NAME = SQL_ROBERTA.format(id=_CLASS)
_SENTENCES = f"""st AS (SELECT doc_id, unnest({sql_sentences()}) AS sentence,
    generate_subscripts({sql_sentences()}, 1)::BIGINT - 1 AS pos FROM documents),
    {sql_softmax('st', 'doc_id, pos', SENTIMENT_MARKERS, text='sentence')}"""
_SENTENCE_DIFF = f"WITH {_SENTENCES} SELECT doc_id, pos, round(p2 - p0, 6) AS score FROM sm"
_RAW = "'LABEL_' || " + sql_argmax(["l0", "l1", "l2"])
_SCORED = f"""{SQL_LEXICON}, tok AS (SELECT doc_id, unnest({sql_tokens()}) AS token FROM documents),
    hits AS (SELECT doc_id, sum(valence) AS x FROM tok JOIN lex USING (token) GROUP BY doc_id),
    lexed AS (SELECT d.doc_id, d.lang, round(coalesce(x, 0) / sqrt(coalesce(x, 0) * coalesce(x, 0) + 15), 4) AS s
        FROM documents d LEFT JOIN hits USING (doc_id))"""

QUERIES = {
    "model_sentence_signed": (
        model_sentence_signed,
        f"WITH {_SENTENCES} SELECT doc_id, pos, round({sql_signed(_NAME, _TOP)}, 6) AS score FROM sm",
    ),
    "model_sentence_prob_diff": (model_sentence_prob_diff, _SENTENCE_DIFF),
    "model_sentence_by_rows": (model_sentence_by_rows, _SENTENCE_DIFF),
    "model_doc_signed": (
        model_doc_signed,
        f"WITH {_DOCS} SELECT doc_id, round({sql_signed(_NAME, _TOP)}, 6) AS doc_sentiments FROM sm",
    ),
    "label_map": (
        label_map,
        f"""WITH {_DOCS}, r AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'roberta' WHEN 'de' THEN 'ALBERT'
            ELSE 'distilbert' END AS model, {_RAW} AS raw_label FROM sm)
            SELECT doc_id, model, raw_label, CASE
            WHEN model = 'roberta' AND raw_label = 'LABEL_0' THEN 'NEGATIVE'
            WHEN model = 'roberta' AND raw_label = 'LABEL_1' THEN 'NEUTRAL'
            WHEN model = 'roberta' AND raw_label = 'LABEL_2' THEN 'POSITIVE'
            WHEN model = 'ALBERT' AND raw_label = 'LABEL_0' THEN 'NEGATIVE'
            WHEN model = 'ALBERT' AND raw_label = 'LABEL_1' THEN 'POSITIVE' ELSE raw_label END AS label FROM r""",
    ),
    "signed_polarity": (
        signed_polarity,
        f"""WITH {_DOCS}, r AS (SELECT doc_id, {_NAME} AS label, {_TOP} AS c FROM sm)
            SELECT doc_id, label, round(c, 6) AS confidence, round({sql_signed('label', 'c')}, 6) AS score FROM r""",
    ),
    "softmax_probs": (
        softmax_probs,
        f"WITH {_DOCS} SELECT doc_id, {', '.join(f'round({p}, 6) AS {p}' for p in _PROBS)} FROM sm",
    ),
    "prob_diff": (prob_diff, f"WITH {_DOCS} SELECT doc_id, round(p2 - p0, 6) AS score FROM sm"),
    "binarize": (
        binarize,
        f"""WITH {_SCORED}, h AS (SELECT doc_id, s::DOUBLE AS score FROM lexed UNION ALL
            VALUES (-1, NULL), (-2, 'nan'::DOUBLE), (-3, 0), (-4, 0), (-5, 1), (-6, -1))
            SELECT doc_id::BIGINT AS doc_id, {sql_binarize('score')} AS sign FROM h""",
    ),
    "argmax_label": (
        argmax_label,
        f"WITH {_DOCS} SELECT doc_id, {sql_argmax(['l0', 'l1', 'l2'])} AS class_id, {_RAW} AS label FROM sm",
    ),
    "udf_scorer": (
        udf_scorer,
        f"WITH {_DOCS} SELECT doc_id, round(l0, 6) AS l0, round(l1, 6) AS l1, round(l2, 6) AS l2 FROM sm",
    ),
    "batch_invariance": (
        batch_invariance,
        f"""WITH {_DOCS} SELECT doc_id, round(p2 - p0, 6) AS dynamic_score, round(p2 - p0, 6) AS sequential_score,
            round(p2 - p0, 6) AS none_score FROM sm""",
    ),
    "ensemble": (
        ensemble,
        f"""WITH {_DOCS}, {_SCORED} SELECT doc_id, round(((p2 - p0) + s) / 2, 6) AS ensemble_score
            FROM sm JOIN lexed USING (doc_id)""",
    ),
    "multiclass_sentiment": (
        multiclass_sentiment,
        f"WITH {_DOCS} SELECT doc_id, {SQL_ROBERTA.format(id=sql_argmax(['l0', 'l1', 'l2']))} AS sentiment FROM sm",
    ),
}
