"""Sentences, tokens and lexicon scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens import PhraseLexicon, score_sentiment
from textlens.functions import text as X
from textlens.functions.lexicon_rules import RuleLexicon, Rules
from textlens.functions.scores import binarize
from textlens.operators.sentences import (
    DOC_SCORE_COLUMN, add_sentence_count, add_sentences, explode_sentences,
    regroup_sentences, sentence_rows,
)
from textlens.session import shared_path
from textlens.operators.abbreviations import THRESHOLD, WORD, fit_abbreviations
from textlens.streaming.score_stream import read_batches, read_stream, score_stream, score_stream_in_batches
from workload.common import (
    LEXICON, SENTIMENT, SENTIMENT_MARKERS, SQL_LEXICON, SQL_WORD_EDGES, documents, lexicon, lexicon_table, rounded, sql_binarize,
    sql_sentences, sql_softmax, sql_tokens, table,
)

TOKEN_LIMIT = 16


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", F.explode(X.sentences("text")).alias("sentence"))


def sentence_explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = explode_sentences(documents(spark, sf), ["doc_id"], "text")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def sentence_regroup(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    rows = explode_sentences(docs, ["doc_id"], "text").withColumn("chars", F.length("sentence"))
    grouped = regroup_sentences(docs.select("doc_id"), rows, ["doc_id"], "chars", "chars_lst")
    return grouped.select(
        "doc_id", F.size("chars_lst").cast("bigint").alias("sentences"), F.array_join("chars_lst", ",").alias("chars")
    )


def sentence_count(spark: SparkSession, sf: str) -> DataFrame:
    counted = add_sentence_count(add_sentences(documents(spark, sf, "lang"), "text"))
    return counted.groupBy("lang").agg(F.sum("sentence_count").alias("sentences"), F.count("*").alias("documents"))


def truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", X.truncate_tokens("text", TOKEN_LIMIT).alias("text"))


def exploded_scores(scored: DataFrame, keys: list[str]) -> DataFrame:
    return sentence_rows(scored, keys).drop("sentence")


def lexicon_sentence(spark: SparkSession, sf: str) -> DataFrame:
    return exploded_scores(score_sentiment(documents(spark, sf), "text", lexicon()), ["doc_id"])


def lexicon_doc(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_sentiment(documents(spark, sf), "text", lexicon(), level="document")
    return scored.select("doc_id", DOC_SCORE_COLUMN)


def lexicon_join_sentence(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    keys = ["conv_id", "turn"]
    scored = score_sentiment(turns, "text", lexicon_table(spark), keys=keys, max_inline=0)
    return exploded_scores(scored, keys)


def lexicon_join_doc(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_sentiment(
        documents(spark, sf), "text", lexicon_table(spark), level="document", keys=["doc_id"], max_inline=0
    )
    return scored.select("doc_id", DOC_SCORE_COLUMN)


# Rule words that occur in the tables.
RULES = Rules(
    degrees={"in": 0.293, "that": 0.293, "to": -0.293}, negations=("is", "was"),
    weakening_phrases=(("to", "in"), ("is", "in")), contrast="by",
)


def lexicon_rules_doc(spark: SparkSession, sf: str) -> DataFrame:
    ruled = RuleLexicon(LEXICON, RULES)
    scored = score_sentiment(documents(spark, sf), "text", ruled, level="document")
    return scored.select("doc_id", DOC_SCORE_COLUMN)


def lexicon_rules_sentence(spark: SparkSession, sf: str) -> DataFrame:
    """The rules for each sentence, with a lexicon table that is sent to the tasks."""
    scored = score_sentiment(documents(spark, sf), "text", lexicon_table(spark), rules=RULES, max_inline=0)
    return exploded_scores(scored, ["doc_id"])


def lexicon_rules_table_doc(spark: SparkSession, sf: str) -> DataFrame:
    """The rules with a lexicon table that is joined."""
    scored = score_sentiment(
        documents(spark, sf), "text", lexicon_table(spark), level="document", rules=RULES, max_inline=0, max_sent=0
    )
    return scored.select("doc_id", DOC_SCORE_COLUMN)


PHRASES = {
    "the": 0.5, "of": -0.5, "and": 1.0, "of the": 2.0, "the of": -1.0, "the the": 0.7, "and the": 1.3, "of the and": -2.5,
    "in the of": 1.7, "de la": 0.9, "la de la": -1.1, "der und": 0.6,
}


def lexicon_phrases_doc(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_sentiment(documents(spark, sf), "text", PhraseLexicon(PHRASES), level="document")
    return scored.select("doc_id", DOC_SCORE_COLUMN)


def lexicon_phrases_table_doc(spark: SparkSession, sf: str) -> DataFrame:
    entries = spark.createDataFrame(list(PHRASES.items()), "token string, valence double")
    scored = score_sentiment(documents(spark, sf), "text", entries, level="document", phrases=True, max_inline=0)
    return scored.select("doc_id", DOC_SCORE_COLUMN)


def lexicon_salted_doc(spark: SparkSession, sf: str) -> DataFrame:
    """The join that a lexicon beyond the limit of what is sent takes."""
    scored = score_sentiment(
        documents(spark, sf), "text", lexicon_table(spark), level="document", max_inline=0, max_sent=0
    )
    return scored.select("doc_id", DOC_SCORE_COLUMN)


def sentiment_flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to sentences to signed scores, with the binarized score and sentence beside it."""
    docs = documents(spark, sf, "lang")
    rows = sentence_rows(score_sentiment(docs, "text", lexicon()), ["doc_id", "lang"])
    return rows.withColumn("sign", binarize(F.col("score")))


def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a stream of files, scored in place into a sink that is then read."""
    documents_ = table(spark, sf, "documents")
    # A table is a folder of part files at scale and may be a single file in a folder of tables.
    folder = documents_.inputFiles()[0].rsplit("/", 1)[0]
    glob = "*.parquet" if folder.endswith("documents.parquet") else "documents.parquet"
    stream = read_stream(spark, folder, documents_.schema, glob=glob).select("doc_id", "text")
    sink, log = shared_path(spark, "stream-sink"), shared_path(spark, "stream-log")

    def score(df: DataFrame) -> DataFrame:
        return score_sentiment(df, "text", lexicon()).drop("text")

    score_stream(stream, score, sink, log).awaitTermination()
    return exploded_scores(spark.read.parquet(sink), ["doc_id"])


def stream_by_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same stream, its sentences spread over the cluster in every batch and brought together again."""
    documents_ = table(spark, sf, "documents")
    folder = documents_.inputFiles()[0].rsplit("/", 1)[0]
    glob = "*.parquet" if folder.endswith("documents.parquet") else "documents.parquet"
    stream = read_stream(spark, folder, documents_.schema, glob=glob).select("doc_id", "text")
    sink, log = shared_path(spark, "batch-sink"), shared_path(spark, "batch-log")

    def score(df: DataFrame) -> DataFrame:
        return score_sentiment(df, "text", SENTIMENT, score_mode="prob_diff", by_rows=True).drop("text")

    score_stream_in_batches(stream, score, sink, log).awaitTermination()
    return exploded_scores(read_batches(spark, sink), ["doc_id"]).withColumn("score", rounded("score"))


def sentence_split_learned(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences with the abbreviations that the documents themselves show."""
    docs = documents(spark, sf)
    learned = fit_abbreviations(docs, "text")
    return docs.select("doc_id", F.explode(learned.sentences("text")).alias("sentence"))


def sql_sentence_scores(source: str, keys: str) -> str:
    """CTEs ending in ``scored``(keys, pos, sentence, score)."""
    return f"""{SQL_LEXICON},
        st AS (SELECT {keys}, unnest({sql_sentences()}) AS sentence,
            generate_subscripts({sql_sentences()}, 1)::BIGINT - 1 AS pos FROM {source}),
        tok AS (SELECT {keys}, pos, unnest({sql_tokens('sentence')}) AS token FROM st),
        hits AS (SELECT {keys}, pos, sum(valence) AS x FROM tok JOIN lex USING (token) GROUP BY ALL),
        scored AS (SELECT {keys}, pos, sentence,
            round(coalesce(x, 0) / sqrt(coalesce(x, 0) * coalesce(x, 0) + 15), 4)::DOUBLE AS score
            FROM st LEFT JOIN hits USING ({keys}, pos))"""


SQL_DOC_SCORES = f"""WITH {SQL_LEXICON},
    tok AS (SELECT doc_id, unnest({sql_tokens()}) AS token FROM documents),
    hits AS (SELECT doc_id, sum(valence) AS x FROM tok JOIN lex USING (token) GROUP BY doc_id)
    SELECT d.doc_id, round(coalesce(x, 0) / sqrt(coalesce(x, 0) * coalesce(x, 0) + 15), 4)::DOUBLE AS doc_sentiments
    FROM documents d LEFT JOIN hits USING (doc_id)"""
SQL_SENTENCE_SCORES = f"WITH {sql_sentence_scores('documents', 'doc_id')} SELECT doc_id, pos, score FROM scored"
SQL_EXPLODED = f"""SELECT doc_id, unnest({sql_sentences()}) AS sentence,
    generate_subscripts({sql_sentences()}, 1)::BIGINT - 1 AS pos FROM documents"""



def _sql_neighbour(value: str, d: int) -> str:
    """Effect of the word d places back on a valence."""
    damping = (1.0, 0.95, 0.9)[d - 1]
    stress = f"CASE WHEN cap{d} AND stressed THEN CASE WHEN {value} > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END::DOUBLE"
    pushed = f"(CASE WHEN {value} < 0 THEN -degree{d} ELSE degree{d} END + {stress}) * {damping}::DOUBLE"
    changed = f"({value} + coalesce({pushed}, 0)) * CASE WHEN neg{d} THEN -0.74 ELSE 1 END::DOUBLE"
    if d == 3:
        for first, second in RULES.weakening_phrases:
            for place in (3, 2):
                changed += (
                    f" - CASE WHEN low{place} = '{first}' AND low{place - 1} = '{second}' THEN 0.293 ELSE 0 END::DOUBLE"
                )
    return f"CASE WHEN low{d} IS NOT NULL AND valence{d} IS NULL THEN {changed} ELSE {value} END"


def _sql_rules(source: str = "documents", key: str = "doc_id", out: str = "doc_sentiments") -> str:
    """The rules on rows: one per word, its neighbours by lag. ``source`` has the key and a ``text``."""
    bare = f"trim(w, {SQL_WORD_EDGES})"
    words = rf"string_split_regex(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\s+')"
    degree = " ".join(f"WHEN '{w}' THEN {v}::DOUBLE" for w, v in RULES.degrees.items())
    negations = ", ".join(f"'{w}'" for w in RULES.negations)
    lags = ", ".join(
        f"lag({c}, {d}) OVER by_doc AS {c}{d}" for d in (1, 2, 3) for c in ("low", "valence", "degree", "neg", "cap")
    )
    return f"""{SQL_LEXICON},
        raw AS (SELECT {key}, unnest({words}) AS w, generate_subscripts({words}, 1) AS i FROM {source}),
        cut AS (SELECT {key}, i, CASE WHEN length({bare}) <= 2 THEN w ELSE {bare} END AS w FROM raw),
        known AS (SELECT {key}, i, w, lower(w) AS low, valence, CASE lower(w) {degree} END AS degree,
            lower(w) IN ({negations}) OR contains(lower(w), 'n''t') AS neg, upper(w) = w AND lower(w) <> w AS cap
            FROM cut LEFT JOIN lex ON lower(w) = token),
        around AS (SELECT *, {lags}, count(*) FILTER (WHERE cap) OVER whole AS caps, count(*) OVER whole AS n,
            min(i) FILTER (WHERE low = '{RULES.contrast}') OVER whole AS turn FROM known
            WINDOW by_doc AS (PARTITION BY {key} ORDER BY i), whole AS (PARTITION BY {key})),
        hit AS (SELECT *, caps > 0 AND caps < n AS stressed FROM around WHERE valence IS NOT NULL AND degree IS NULL),
        s0 AS (SELECT *, valence + CASE WHEN cap AND stressed THEN sign(valence) * 0.733 ELSE 0 END::DOUBLE AS v0 FROM hit),
        s1 AS (SELECT *, {_sql_neighbour('v0', 1)} AS v1 FROM s0),
        s2 AS (SELECT *, {_sql_neighbour('v1', 2)} AS v2 FROM s1),
        s3 AS (SELECT *, {_sql_neighbour('v2', 3)} AS v3 FROM s2),
        total AS (SELECT {key}, sum(v3 * CASE WHEN turn IS NULL OR i = turn THEN 1 WHEN i < turn THEN 0.5
            ELSE 1.5 END::DOUBLE) AS x FROM s3 GROUP BY {key}),
        marked AS (SELECT {key}, coalesce(x, 0) AS x, least(length(text) - length(replace(text, '!', '')), 4)
            * 0.292::DOUBLE + CASE WHEN q > 3 THEN 0.96 WHEN q > 1 THEN q * 0.18 ELSE 0 END::DOUBLE AS e
            FROM (SELECT *, length(text) - length(replace(text, '?', '')) AS q FROM {source}) LEFT JOIN total USING ({key})),
        final AS (SELECT {key}, CASE WHEN x > 0 THEN x + e WHEN x < 0 THEN x - e ELSE x END AS x FROM marked)
        SELECT {key}, round(x / sqrt(x * x + 15), 4)::DOUBLE AS {out} FROM final"""


def _sql_phrases() -> str:
    """Longest entry first, left to right: a fold over the places of a text."""
    longest = max(len(p.split()) for p in PHRASES)
    runs = {n: " || ' ' || ".join(f"tk[i + {k}]" for k in range(n)) for n in range(1, longest + 1)}
    listed = lambda n: [(p, v) for p, v in PHRASES.items() if len(p.split()) == n]
    words = " ".join(
        f"WHEN {runs[n]} IN ({', '.join(repr(p) for p, _ in listed(n))}) THEN {n}" for n in range(longest, 0, -1)
    )
    value = " ".join(f"WHEN {runs[len(p.split())]} = '{p}' THEN {v}" for p, v in sorted(PHRASES.items(), key=lambda e: -len(e[0].split())))
    return f"""WITH t AS (SELECT doc_id, {sql_tokens()} AS tk FROM documents),
        e AS (SELECT doc_id, i, CASE {words} ELSE 0 END AS words, CASE {value} ELSE 0 END::DOUBLE AS v
            FROM (SELECT doc_id, tk, unnest(range(1, len(tk) + 1)) AS i FROM t)),
        l AS (SELECT doc_id, list(struct_pack(i := i, words := words, v := v) ORDER BY i) AS es FROM e WHERE words > 0 GROUP BY doc_id),
        r AS (SELECT doc_id, list_reduce(list_prepend(struct_pack(i := 1::BIGINT, words := 0, v := 0::DOUBLE), es), lambda a, x:
            CASE WHEN x.i < a.i THEN a ELSE struct_pack(i := x.i + x.words, words := 0, v := a.v + x.v) END).v AS x FROM l)
        SELECT doc_id, round(coalesce(x, 0) / sqrt(coalesce(x, 0) * coalesce(x, 0) + 15), 4)::DOUBLE AS doc_sentiments
        FROM documents LEFT JOIN r USING (doc_id)"""


_RULES_BY_SENTENCE = f"""WITH st AS (SELECT doc_id, unnest({sql_sentences()}) AS text,
        generate_subscripts({sql_sentences()}, 1)::BIGINT - 1 AS pos FROM documents),
    {_sql_rules('st', 'doc_id, pos', 'score')}"""


def _sql_learned() -> str:
    """The same measure from counts of words, then boundaries kept or not, piece by piece."""
    word = WORD.replace("'", "''").replace(chr(92) + "p{L}", "\\pL").replace("[\\pL.]", "[\\pL.]")
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    words = rf"string_split_regex(trim(text, {ws}), '\s+')"
    capital = "'^[(\\[\"'']*\\p{Lu}'"
    pieces = rf"string_split(regexp_replace(trim(text, {ws}), '([.!?])(\s+)', '\1\2' || chr(1), 'g'), chr(1))"
    return rf"""WITH o AS (SELECT w, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM (
            SELECT doc_id, unnest({words}) AS w, generate_subscripts({words}, 1) AS i FROM documents)),
        k AS (SELECT lower(regexp_extract(w, '{word}', 1)) AS word, regexp_extract(w, '{word}', 2) = '.' AS period, nxt FROM o),
        c AS (SELECT word, count(*) FILTER (period) AS p, count(*) FILTER (NOT period) AS r,
            count(*) FILTER (period AND regexp_matches(nxt, {capital})) AS ca, count(*) FILTER (period AND nxt IS NOT NULL) AS af
            FROM k WHERE word <> '' GROUP BY word),
        s AS (SELECT sum(p) / sum(p + r) AS q FROM c),
        a AS (SELECT word, ca > af * 0.5 AS names, length(replace(word, '.', '')) AS n FROM c, s WHERE p > 0 AND
            2 * (p * ln(0.99::DOUBLE) + r * ln(1 - 0.99::DOUBLE) - p * ln(q) - r * ln(1 - q)) * exp(-length(replace(word, '.', '')))
            * (length(word) - length(replace(word, '.', '')) + 1) * pow(length(replace(word, '.', ''))::DOUBLE, -r) >= {THRESHOLD}),
        x AS (SELECT doc_id, unnest({pieces}) AS piece, generate_subscripts({pieces}, 1) AS i FROM documents),
        y AS (SELECT *, lead(piece) OVER (PARTITION BY doc_id ORDER BY i) AS nxt,
            lower(regexp_extract(regexp_extract(piece, '(\S+)\s*$', 1), '{word}', 1)) AS final FROM x),
        j AS (SELECT doc_id, i, piece, nxt IS NULL OR NOT (regexp_matches(piece, '\.\s*$') AND word IS NOT NULL
            AND (names OR NOT regexp_matches(nxt, {capital}))) AS ends FROM y LEFT JOIN a ON final = word),
        g AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM j),
        t AS (SELECT doc_id, n, trim(string_agg(piece, '' ORDER BY i), {ws}) AS sentence FROM g GROUP BY ALL)
        SELECT doc_id, sentence FROM t WHERE sentence <> ''"""


_BY_ROWS = f"""WITH st AS (SELECT doc_id, unnest({sql_sentences()}) AS sentence,
    generate_subscripts({sql_sentences()}, 1)::BIGINT - 1 AS pos FROM documents),
    {sql_softmax('st', 'doc_id, pos', SENTIMENT_MARKERS, text='sentence')} SELECT doc_id, pos, round(p2 - p0, 6) AS score FROM sm"""

QUERIES = {
    "sentence_split_learned": (sentence_split_learned, _sql_learned()),
    "stream_by_rows": (stream_by_rows, _BY_ROWS),
    "lexicon_rules_doc": (lexicon_rules_doc, "WITH " + _sql_rules()),
    "lexicon_rules_table_doc": (lexicon_rules_table_doc, "WITH " + _sql_rules()),
    "lexicon_rules_sentence": (lexicon_rules_sentence, _RULES_BY_SENTENCE),
    "lexicon_phrases_doc": (lexicon_phrases_doc, _sql_phrases()),
    "lexicon_phrases_table_doc": (lexicon_phrases_table_doc, _sql_phrases()),
    "sentence_split": (sentence_split, f"SELECT doc_id, unnest({sql_sentences()}) AS sentence FROM documents"),
    "sentence_explode": (sentence_explode, SQL_EXPLODED),
    "sentence_regroup": (
        sentence_regroup,
        f"""WITH st AS ({SQL_EXPLODED}), j AS (SELECT doc_id, count(*) AS n,
            string_agg(length(sentence)::VARCHAR, ',' ORDER BY pos) AS chars FROM st GROUP BY doc_id)
            SELECT doc_id, coalesce(n, 0)::BIGINT AS sentences, coalesce(chars, '') AS chars
            FROM documents LEFT JOIN j USING (doc_id)""",
    ),
    "sentence_count": (
        sentence_count,
        f"""SELECT lang, sum(len({sql_sentences()}))::BIGINT AS sentences, count(*)::BIGINT AS documents
            FROM documents GROUP BY lang""",
    ),
    "truncate_tokens": (
        truncate_tokens,
        rf"""SELECT doc_id, array_to_string(string_split_regex(trim(text, ' ' || chr(9) || chr(10) || chr(11)
            || chr(12) || chr(13)), '\s+')[1:{TOKEN_LIMIT}], ' ') AS text FROM documents""",
    ),
    "lexicon_sentence": (lexicon_sentence, SQL_SENTENCE_SCORES),
    "lexicon_doc": (lexicon_doc, SQL_DOC_SCORES),
    "lexicon_join_sentence": (
        lexicon_join_sentence,
        f"WITH {sql_sentence_scores('conversations', 'conv_id, turn')} SELECT conv_id, turn, pos, score FROM scored",
    ),
    "lexicon_join_doc": (lexicon_join_doc, SQL_DOC_SCORES),
    "lexicon_salted_doc": (lexicon_salted_doc, SQL_DOC_SCORES),
    "sentiment_flagship": (
        sentiment_flagship,
        f"""WITH {sql_sentence_scores('documents', 'doc_id')}
            SELECT doc_id, lang, pos, sentence, score, {sql_binarize('score')} AS sign
            FROM scored JOIN documents USING (doc_id)""",
    ),
    "stream_scores": (stream_scores, SQL_SENTENCE_SCORES),
}
