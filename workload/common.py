"""Stand-in scorers, shared inputs and shared SQL fragments of the registered queries.

The stand-ins need no model files: a five-word lexicon and marker-word shares as class logits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlens import Lexicon, MarkerScorer
from textlens.functions import scores as S
from textlens.operators.labels import LabelIndex
from textlens.operators.sentences import spread
from textlens.operators.split import stratified_split

LEXICON = {"the": 0.5, "of": -0.5, "and": 1.0, "with": -1.5, "this": 2.0}

SENTIMENT_MARKERS = {
    "LABEL_0": ("of", "la", "der"),
    "LABEL_1": ("the", "de", "und"),
    "LABEL_2": ("and", "en", "die"),
}
LANGUAGE_MARKERS = {
    "de": ("der", "die", "und"),
    "en": ("the", "of", "and"),
    "es": ("el", "los", "y"),
    "fr": ("le", "et", "les"),
}
SCALE = 10.0
DIGITS = 6

SENTIMENT = MarkerScorer(SENTIMENT_MARKERS, SCALE)
LANGUAGE = MarkerScorer(LANGUAGE_MARKERS, SCALE)
# The language rule with one marker per class: the "first epoch" of the report queries.
LANGUAGE_FIRST = MarkerScorer({k: v[:1] for k, v in LANGUAGE_MARKERS.items()}, SCALE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *columns)
    return spread(docs, ["doc_id"])


def lexicon() -> Lexicon:
    return Lexicon(LEXICON)


def lexicon_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def rounded(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, DIGITS)


def language_index(spark: SparkSession) -> LabelIndex:
    return LabelIndex.of(spark, LANGUAGE.labels)


def language_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pred(doc_id, y_true, y_pred, probs) of the language rule over all documents."""
    docs = documents(spark, sf_dir, "lang").select(
        "doc_id", "lang", LANGUAGE.column(F.col("text")).alias("logits")
    )
    scored = docs.withColumn("probs", S.softmax(F.col("logits"), len(LANGUAGE.labels)))
    encoded = language_index(spark).encode(scored, "lang", "y_true")
    return encoded.select("doc_id", "y_true", S.argmax(F.col("probs")).alias("y_pred"), "probs")


PHASE_EPOCHS = [("dev-set", 1), ("dev-set", 2), ("test-set", 3)]


def epoch_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pred(phase, epoch, y_true, y_pred): both rules on validation rows, the full one on test rows.

    All phases come from one scan; train rows drop out before any text is tokenized.
    """
    docs = documents(spark, sf_dir, "lang")
    held_out = stratified_split(docs, "doc_id", "lang").where("split <> 'train'")
    encoded = language_index(spark).encode(held_out, "lang", "y_true")
    first = S.argmax(LANGUAGE_FIRST.column(F.col("text")))
    final = S.argmax(LANGUAGE.column(F.col("text")))

    def outcome(phase: str, epoch: int, predicted: Column) -> Column:
        return F.struct(
            F.lit(phase).alias("phase"), F.lit(epoch).cast("bigint").alias("epoch"), predicted.alias("y_pred")
        )

    chosen = F.when(F.col("split") == "test", F.array(outcome("test-set", 3, final))).otherwise(
        F.array(outcome("dev-set", 1, first), outcome("dev-set", 2, final))
    )
    return encoded.select("y_true", F.explode(chosen).alias("o")).select("o.*", "y_true")


# SQL fragments ---------------------------------------------------------------------------------

_PUNCT = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
SQL_WORD_EDGES = f"'{_PUNCT}'"
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def sql_tokens(text: str = "text") -> str:
    return rf"regexp_extract_all(lower({text}), '[^\s[:punct:]]+(?:[[:punct:]]+[^\s[:punct:]]+)*')"


def sql_sentences(text: str = "text") -> str:
    marked = rf"regexp_replace(trim({text}, {_WS}), '([.!?])\s+', '\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def sql_values(rows: list[tuple], columns: str) -> str:
    """An inline table."""
    def literal(value) -> str:
        return f"'{value}'" if isinstance(value, str) else f"{value}::DOUBLE"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS inline_rows({columns})"


SQL_LEXICON = f"lex AS (SELECT * FROM {sql_values(list(LEXICON.items()), 'token, valence')})"


def sql_logits(markers: dict, tk: str = "tk", scale: float = SCALE) -> list[str]:
    def one(words) -> str:
        listed = ", ".join(f"'{w}'" for w in words)
        return f"(len(list_filter({tk}, lambda w: w IN ({listed}))) / greatest(len({tk}), 1)) * {scale}::DOUBLE"

    return [one(words) for words in markers.values()]


def sql_softmax(source: str, columns: str, markers: dict, name: str = "sm", text: str = "text") -> str:
    """CTEs ending in ``name``(columns, l0.., p0..): logits and probabilities per row of source."""
    k = range(len(markers))
    logits = ", ".join(f"{e} AS l{i}" for i, e in enumerate(sql_logits(markers)))
    top = "greatest(" + ", ".join(f"l{i}" for i in k) + ")"
    exps = ", ".join(f"exp(l{i} - {top}) AS e{i}" for i in k)
    total = " + ".join(f"e{i}" for i in k)
    probs = ", ".join(f"e{i} / ({total}) AS p{i}" for i in k)
    return (
        f"{name}_t AS (SELECT {columns}, {sql_tokens(text)} AS tk FROM {source}), "
        f"{name}_l AS (SELECT {columns}, {logits} FROM {name}_t), "
        f"{name}_e AS (SELECT *, {exps} FROM {name}_l), "
        f"{name} AS (SELECT *, {probs} FROM {name}_e)"
    )


def sql_argmax(values: list[str]) -> str:
    """Position of the largest, first wins."""
    return f"(list_position([{', '.join(values)}], greatest({', '.join(values)})) - 1)::BIGINT"


def sql_signed(label: str, confidence: str) -> str:
    return (
        f"CASE WHEN lower({label}) LIKE '%negative%' THEN -({confidence}) "
        f"WHEN lower({label}) LIKE '%positive%' THEN {confidence} "
        f"WHEN lower({label}) LIKE '%neutral%' THEN {confidence} - 0.5::DOUBLE ELSE {confidence} END"
    )


def sql_binarize(score: str) -> str:
    return (
        f"CASE WHEN {score} IS NULL THEN NULL WHEN isnan({score}) THEN 0.0::DOUBLE "
        f"WHEN {score} > 0 THEN 1.0::DOUBLE WHEN {score} < 0 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END"
    )


SQL_ROBERTA = "CASE {id} WHEN 0 THEN 'NEGATIVE' WHEN 1 THEN 'NEUTRAL' ELSE 'POSITIVE' END"
SQL_CLASS_IDS = "(list_position(['de', 'en', 'es', 'fr'], lang) - 1)::BIGINT"

# pred(doc_id, y_true, y_pred, p0..p3) of the language rule
SQL_PRED = (
    sql_softmax("documents", "doc_id, lang", LANGUAGE_MARKERS)
    + f", pred AS (SELECT doc_id, {SQL_CLASS_IDS} AS y_true, "
    + sql_argmax(["p0", "p1", "p2", "p3"])
    + " AS y_pred, p0, p1, p2, p3 FROM sm)"
)

SQL_SPLIT = """
    ranked AS (SELECT doc_id, lang, text,
        row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id::VARCHAR) AS r,
        count(*) OVER (PARTITION BY lang) AS n FROM documents),
    cut1 AS (SELECT *, CASE WHEN n < 2 THEN 0 ELSE round(n * 0.1::DOUBLE) END AS k1 FROM ranked),
    cut2 AS (SELECT *, CASE WHEN n < 2 THEN 0 ELSE k1 + round((n - k1) * 0.1::DOUBLE) END AS k2 FROM cut1),
    parts AS (SELECT doc_id, lang, text, CASE WHEN r <= k1 THEN 'test' WHEN r <= k2 THEN 'validation'
        ELSE 'train' END AS split FROM cut2)"""


def _sql_epoch_predictions() -> str:
    final = sql_argmax(sql_logits(LANGUAGE_MARKERS))
    first = sql_argmax(sql_logits({k: v[:1] for k, v in LANGUAGE_MARKERS.items()}))
    return (
        SQL_SPLIT + f", held AS (SELECT split, {SQL_CLASS_IDS} AS y_true, {sql_tokens()} AS tk "
        "FROM parts WHERE split <> 'train'), "
        f"pred AS (SELECT 'dev-set' AS phase, 1::BIGINT AS epoch, y_true, {first} AS y_pred FROM held "
        "WHERE split = 'validation' "
        f"UNION ALL SELECT 'dev-set', 2, y_true, {final} FROM held WHERE split = 'validation' "
        f"UNION ALL SELECT 'test-set', 3, y_true, {final} FROM held WHERE split = 'test')"
    )


SQL_EPOCH_PRED = _sql_epoch_predictions()

SQL_DIM = "dim AS (SELECT * FROM (VALUES (0::BIGINT, 'de'), (1, 'en'), (2, 'es'), (3, 'fr')) AS d(class_id, label_name))"


def sql_report(groups: list[str], grid: str) -> str:
    """CTEs ending in ``rep``: per group and class counts, precision, recall, F1.

    ``grid`` selects the groups to report (one row each, or a single dummy row).
    """
    g = "".join(f"{name}, " for name in groups)
    on = "".join(f" AND p.{name} = c.{name}" for name in groups)
    gr_columns = f"({', '.join(groups)})" if groups else ""
    return f"""
    {SQL_DIM},
    grid AS (SELECT * FROM dim, ({grid}) AS gr{gr_columns}),
    cnt AS (SELECT {''.join(f'c.{n}, ' for n in groups)} c.class_id, c.label_name,
        (SELECT count(*) FROM pred p WHERE p.y_true = c.class_id{on})::BIGINT AS support,
        (SELECT count(*) FROM pred p WHERE p.y_true = c.class_id AND p.y_pred = c.class_id{on})::BIGINT AS tp,
        (SELECT count(*) FROM pred p WHERE p.y_true <> c.class_id AND p.y_pred = c.class_id{on})::BIGINT AS fp,
        (SELECT count(*) FROM pred p WHERE p.y_true = c.class_id AND p.y_pred <> c.class_id{on})::BIGINT AS fn
        FROM grid c),
    rep AS (SELECT {g} class_id, label_name, support, tp, fp, fn,
        CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END::DOUBLE AS precision,
        CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END::DOUBLE AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END::DOUBLE AS f1_score FROM cnt)"""


def sql_averages(groups: list[str]) -> str:
    """CTE ``av``: macro and weighted average rows per group."""
    g = "".join(f"{name}, " for name in groups)
    by = f" GROUP BY {', '.join(groups)}" if groups else ""
    macro = ", ".join(f"avg({m}) FILTER (WHERE tp + fp + fn > 0) AS {m}" for m in ("precision", "recall", "f1_score"))
    weighted = ", ".join(f"sum({m} * support) / sum(support)" for m in ("precision", "recall", "f1_score"))
    return (
        f"av AS (SELECT {g}'macro avg' AS label_name, {macro}, sum(support)::BIGINT AS support FROM rep{by} "
        f"UNION ALL SELECT {g}'weighted avg', {weighted}, sum(support)::BIGINT FROM rep{by})"
    )


SQL_GROUPS = ["phase", "epoch"]
SQL_EPOCH_GRID = "VALUES ('dev-set', 1::BIGINT), ('dev-set', 2), ('test-set', 3)"
