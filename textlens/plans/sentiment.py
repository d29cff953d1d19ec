"""Sentiment scoring: one lazy plan from text to signed scores, and a class with run records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlens.functions import scores as S
from textlens.functions.lexicon import MAX_INLINE_ENTRIES, Lexicon, PhraseLexicon, compound
from textlens.functions.lexicon_rules import RuleLexicon, Rules
from textlens.functions.text import SENTENCE_BOUNDARY, sentences, truncate_tokens
from textlens.operators.abbreviations import Abbreviations
from textlens.operators.lexicon_values import MAX_SENT, with_values
from textlens.operators.scoring import batch_size, computed_once, model_logits
from textlens.operators.sentences import (
    DOC_SCORE_COLUMN,
    SENTENCE_SCORES_COLUMN,
    SENTENCES_COLUMN,
    regroup_sentences,
    repartition_by_rows,
)
from textlens.scorers import Scorer
from textlens.sources.sinks import RunLog, materialise

LEVELS = ("sentence", "document")
SCORE_MODES = ("label_signed", "prob_diff")
LEXICON_MODEL = "vader"


def polarity(
    probabilities: Column, labels: Sequence[str], model: str, score_mode: str = "label_signed",
    positive: int = 2, negative: int = 0,
) -> Column:
    """One signed number from class probabilities.

    ``label_signed``: the top label decides the sign of its confidence. ``prob_diff``:
    P(positive) - P(negative), the neutral class not counting. The two differ by design.
    """
    if score_mode == "prob_diff":
        return S.polarity_difference(probabilities, positive, negative)
    # The label of each class is known while planning, so its case folds to plain arithmetic.
    by_class = [
        S.signed_polarity(S.canonical_label(model, F.lit(label)), F.get(probabilities, F.lit(i)))
        for i, label in enumerate(labels)
    ]
    return F.get(F.array(*by_class), S.argmax(probabilities).cast("int"))


def score_sentiment(
    df: DataFrame,
    text: str,
    scorer: Lexicon | DataFrame | Scorer,
    level: str = "sentence",
    score_mode: str = "label_signed",
    binarize: bool = False,
    model: str = "roberta",
    batching: str = "dynamic",
    max_tokens: int | None = None,
    boundary: str = SENTENCE_BOUNDARY,
    keys: Sequence[str] = (),
    positive: int = 2,
    negative: int = 0,
    max_inline: int = MAX_INLINE_ENTRIES,
    by_rows: bool = False,
    once: bool = True,
    rules: Rules | None = None,
    phrases: bool = False,
    max_sent: int = MAX_SENT,
    abbreviations: Abbreviations | None = None,
    call_size: int | None = None,
) -> DataFrame:
    """Append sentiment to a table of texts; lazy, and every argument is checked first.

    ``scorer``: a ``Lexicon``, a lexicon table (``token``, ``valence``), or a model scorer.
    ``level='sentence'`` appends ``sentences_array`` and ``sentence_sentiments_lst``;
    ``'document'`` appends ``doc_sentiments``. Rows are scored in place and nothing is shuffled: a lexicon table of up to
    ``max_inline`` rows becomes part of the plan, one of up to ``max_sent`` is sent to the tasks. Only a larger one
    is joined, after a Bloom filter. ``rules`` (the published ones or others) or ``phrases`` (entries of several words,
    longest first) say how a table is scored, whatever its size. ``keys`` are not needed; null and repeated ones do no harm.

    ``abbreviations`` keeps sentences whole after the words it lists. ``call_size`` is the largest number of texts of one model call.

    ``by_rows`` (sentence level, model scorer) spreads the sentences themselves over
    the cluster. It stores the rows and pays a shuffle so that a costly model is not held up by the tasks that happen
    to hold the long documents. ``once`` keeps filters on the scores from computing them twice;
    without it they are plain columns, which Spark also drops when nothing reads them.
    """
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; known: {LEVELS}")
    if score_mode not in SCORE_MODES:
        raise ValueError(f"unknown score mode {score_mode!r}; known: {SCORE_MODES}")
    batch_size(batching, level)
    if call_size is not None and call_size <= 0:
        raise ValueError("call_size must be positive")
    if by_rows and (level != "sentence" or isinstance(scorer, (Lexicon, DataFrame))):
        raise ValueError("scoring by rows is for sentences and a model scorer")
    S.check_model_name(model)
    if text not in df.columns:
        raise ValueError(f"no column {text!r} in {df.columns}")
    if (rules is not None or phrases) and not isinstance(scorer, DataFrame):
        raise ValueError("rules and phrases go with a lexicon table; use RuleLexicon or PhraseLexicon otherwise")
    if rules is not None and phrases:
        raise ValueError("a table is scored with rules or with phrases")

    def sign(score: Column) -> Column:
        return S.let(score, S.binarize) if binarize else score

    def append(table: DataFrame, name: str, value: Column) -> DataFrame:
        return computed_once(table, name, value) if once else table.withColumn(name, value)

    def signed(probabilities: Column) -> Column:
        return sign(polarity(probabilities, scorer.labels, model, score_mode, positive, negative))

    def limited(value: Column) -> Column:
        return value if max_tokens is None else truncate_tokens(value, max_tokens)

    if level == "sentence":
        split = sentences(text, boundary) if abbreviations is None else abbreviations.sentences(text, boundary)
        df = df.withColumn(SENTENCES_COLUMN, split)
    if isinstance(scorer, DataFrame):
        found = Lexicon.from_table(scorer, max_entries=max_inline)
        if found is None:
            scheme = _scheme({}, rules, longest_entry(scorer) if phrases else None)
            return _score_with_table(df, text, scorer, scheme, level, max_sent, sign, limited, append)
        scorer = _scheme(found.entries, rules, 0 if phrases else None)

    if level == "document":
        source = limited(F.col(text))
        if isinstance(scorer, Lexicon):
            return append(df, DOC_SCORE_COLUMN, sign(scorer.score(source)))
        df = append(df, "_logits", model_logits(scorer, source, level, batching, call_size))
        df = df.withColumn("_probs", S.softmax(F.col("_logits"), len(scorer.labels)))
        return df.withColumn(DOC_SCORE_COLUMN, signed(F.col("_probs"))).drop("_logits", "_probs")

    source = F.col(SENTENCES_COLUMN)
    if max_tokens is not None:
        source = F.transform(source, limited)
    if isinstance(scorer, Lexicon):
        each = F.transform(source, lambda one: sign(scorer.score(one)))
        return append(df, SENTENCE_SCORES_COLUMN, each)
    if by_rows:
        return _score_by_rows(df, source, scorer, batching, call_size, signed)
    df = append(df, "_logits", model_logits(scorer, source, level, batching, call_size))
    each = F.transform("_logits", lambda one: S.let(S.softmax(one), signed))
    return df.withColumn(SENTENCE_SCORES_COLUMN, each).drop("_logits")


def longest_entry(lexicon: DataFrame) -> int:
    """Words of the longest entry of a lexicon table."""
    words = F.size(F.split(F.trim("token"), r"\s+"))
    return max(1, lexicon.where(F.col("token").isNotNull()).agg(F.max(words)).first()[0] or 1)


def _scheme(entries: Mapping[str, float], rules: Rules | None, longest: int | None) -> Lexicon:
    """How texts are scored, with the entries that are part of the plan; ``longest``: entries may have several words."""
    if rules is not None:
        return RuleLexicon(entries, rules)
    return Lexicon(entries) if longest is None else PhraseLexicon(entries, longest)


def _score_by_rows(
    df: DataFrame, source: Column, scorer: Scorer, batching: str, call_size: int | None,
    signed: Callable[[Column], Column],
) -> DataFrame:
    """Sentences spread over the cluster and sorted by length within a task, so that model calls cost alike and pad little.

    Rows are stored with a number first: null, repeated and equal rows each find their own sentences again.
    """
    spark = df.sparkSession
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()))
    wanted = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = rows.select("_row", F.posexplode(source).alias("pos", "sentence")).repartition(wanted, "_row", "pos")
    pieces = pieces.sortWithinPartitions(F.length("sentence"))
    scored = computed_once(pieces, "_logits", model_logits(scorer, F.col("sentence"), "document", batching, call_size))
    scored = scored.withColumn("_probs", S.softmax(F.col("_logits"), len(scorer.labels)))
    scored = scored.select("_row", "pos", signed(F.col("_probs")).alias("_score"))
    grouped = regroup_sentences(rows, scored, ["_row"], "_score", SENTENCE_SCORES_COLUMN)
    kept = F.when(F.col(SENTENCES_COLUMN).isNotNull(), F.col(SENTENCE_SCORES_COLUMN))
    return grouped.withColumn(SENTENCE_SCORES_COLUMN, kept).drop("_row")


def _score_with_table(
    df: DataFrame, text: str, lexicon: DataFrame, scheme: Lexicon, level: str, max_sent: int,
    sign: Callable[[Column], Column], limited: Callable[[Column], Column],
    append: Callable[[DataFrame, str, Column], DataFrame],
) -> DataFrame:
    document = level == "document"
    texts = F.when(F.col(text).isNotNull(), F.array(limited(F.col(text)))) if document else F.transform(SENTENCES_COLUMN, limited)
    valued = with_values(df, F.transform(texts, scheme.keys), lexicon, "_values", max_sent)
    each = F.zip_with(texts, F.col("_values"), lambda one, values: sign(compound(scheme.valence_sum_of(one, values))))
    if document:
        return append(valued, DOC_SCORE_COLUMN, F.get(each, F.lit(0))).drop("_values")
    return append(valued, SENTENCE_SCORES_COLUMN, each).drop("_values")


def ensemble_score(df: DataFrame, columns: Sequence[str], out: str = "ensemble_score") -> DataFrame:
    """Extension: mean of several score columns; a null score does not count."""
    present = F.filter(F.array(*columns), lambda score: score.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, score: acc + score)
    return df.withColumn(out, F.when(F.size(present) > 0, total / F.size(present)))


def sentiment_class(logits: Column, labels: Sequence[str], model: str) -> Column:
    """Extension: the canonical label itself as the class, not collapsed to a signed number."""
    return S.canonical_label(model, S.pick_label(labels, S.argmax(logits)))


class SentimentAnalyzer:
    """Entry point with the call signature users know.

    ``scorers`` maps model names to scorers; ``vader`` stands for the lexicon. ``transformer_batch_size`` bounds the texts
    of one model call. With ``run_log_path``
    each call appends one record (parameters, success, error); with ``materialise_result`` the
    scored table is written to the shared folder and read back, cutting the lineage. A lexicon table is scored with
    ``lexicon_rules``, the published ones unless others (or None, the plain sum) are given.
    """

    def __init__(
        self,
        spark: SparkSession,
        transformer_batch_size: int = 1028,
        device: str | None = None,
        scorers: dict[str, Lexicon | DataFrame | Scorer] | None = None,
        run_log_path: str | None = None,
        materialise_result: bool = False,
        lexicon_rules: Rules | None = Rules(),
    ):
        if transformer_batch_size <= 0:
            raise ValueError("the batch size must be positive")
        self.spark = spark
        self.transformer_batch_size = transformer_batch_size
        self.device = device or "cpu"
        self.scorers = {name.lower(): scorer for name, scorer in (scorers or {}).items()}
        self.run_log_path = run_log_path
        self.materialise_result = materialise_result
        self.lexicon_rules = lexicon_rules

    def _scorer(self, model_name: str):
        name = model_name.lower()
        if name != LEXICON_MODEL:
            S.check_model_name(name)
        if name not in self.scorers:
            raise ValueError(f"no scorer registered for model {model_name!r}")
        return self.scorers[name]

    def trigger_SentimentInference(
        self,
        df: DataFrame,
        model_name: str = "roberta",
        text_column: str = "text",
        sentParse: bool = True,
        binarize: bool = False,
        enable_batching: str = "dynamic",
        score_mode: str = "label_signed",
        key_columns: Sequence[str] = (),
        repartition: bool = False,
        max_tokens: int | None = None,
        action: Callable[[DataFrame], Any] | None = None,
    ):
        """The scored table; with ``action``, what that makes of it.

        ``action`` (a write, for instance) runs inside the run record, which then has its outcome and the rows it
        went through, observed while it ran; it must read the table. So does ``materialise_result``. Otherwise nothing has
        run when the record is written, and its ``success`` is null.
        """
        parameters = {
            "model_name": model_name,
            "device": self.device,
            "transformer_batch_size": self.transformer_batch_size,
            "sentParse": sentParse,
            "binarize": binarize,
        }
        with RunLog(self.spark, self.run_log_path, parameters) as run:
            scorer = self._scorer(model_name)
            if repartition and sentParse and enable_batching in ("none", "dynamic"):
                df = repartition_by_rows(df, key_columns)
            result = score_sentiment(
                df,
                text_column,
                scorer,
                level="sentence" if sentParse else "document",
                score_mode=score_mode,
                binarize=binarize,
                model="roberta" if model_name.lower() == LEXICON_MODEL else model_name,
                batching=enable_batching,
                keys=key_columns,
                rules=self.lexicon_rules if isinstance(scorer, DataFrame) else None,
                max_tokens=max_tokens,
                call_size=self.transformer_batch_size,
            )
            if self.materialise_result:
                result = run.observed(result, materialise)
            if action is not None:
                return action(result) if self.materialise_result else run.observed(result, action)
        return result
