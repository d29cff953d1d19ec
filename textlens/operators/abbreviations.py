"""Sentence boundaries with abbreviations learned from the texts themselves.

A word is an abbreviation if it goes with a period more strongly than chance allows. The measure is the published one of
Kiss and Strunk (2006): the likelihood ratio of "this word is nearly always followed by a period" against "it is as often as
any word", weighted by its shortness, its inner periods, and against every occurrence without a period. All counts are
one aggregate over the texts with map-side combine; only the abbreviations found reach the plan, where they are a constant.

The period of an abbreviation ends no sentence if the next word is not capitalised, or if this abbreviation usually stands before
capitalised words anyway (``Dr. Smith``). Otherwise it does (``etc. The``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from textlens.functions.lexicon import MAX_INLINE_ENTRIES, InPlanTable
from textlens.functions.scores import let
from textlens.functions.text import SENTENCE_BOUNDARY, WHITESPACE

# Fixed values of the published measure.
THRESHOLD = 0.3
NEARLY_ALWAYS = 0.99
# A word of letters and inner periods, its final period, and marks around it.
WORD = r"^[(\[\"']*(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)[)\]\"',;:!?]*$"
BEFORE_CAPITALS = 0.5
# A character no text may contain; one that does has it treated as white space.
MARK = "￿"


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, with_period, without, capital_after, after): how often each lower-case word has a period, and what follows it then."""
    words = F.split(F.btrim(F.col(text), F.lit(WHITESPACE)), r"\s+")
    pairs = let(words, lambda all_: F.transform(all_, lambda w, i: F.struct(w.alias("w"), F.get(all_, i + 1).alias("next"))))
    rows = df.select(F.explode(pairs).alias("p")).select("p.*")
    # What follows matters after a period only. Words are counted as they stand, so that a pattern reads each of them once.
    capital = F.when(F.contains("w", F.lit(".")), F.col("next").rlike(r"^[(\[\"']*\p{Lu}")).alias("capital")
    rows = rows.select("w", capital).groupBy("w", "capital").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select(
        F.lower(F.regexp_extract("w", WORD, 1)).alias("word"), (F.regexp_extract("w", WORD, 2) == ".").alias("period"), "capital", "n"
    ).where("word <> ''")
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    followed = F.col("period") & F.col("capital").isNotNull()
    return rows.groupBy("word").agg(
        count(F.col("period")).alias("with_period"), count(~F.col("period")).alias("without"),
        count(followed & F.col("capital")).alias("capital_after"), count(followed).alias("after"),
    )


def strength(period_share: float) -> Column:
    """The measure of a row of ``word_counts``, given how often a word has a period at all."""
    def likelihood(p: float) -> Column:
        return F.col("with_period") * math.log(p) + F.col("without") * math.log(1 - p)

    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inner = F.length("word") - letters
    ratio = 2 * (likelihood(NEARLY_ALWAYS) - likelihood(period_share))
    return ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -F.col("without"))


@dataclass(frozen=True)
class Abbreviations:
    """Lower-case words whose period is part of them, and whether they usually stand before capitalised words."""

    entries: dict[str, bool] = field(default_factory=dict)

    def sentences(self, text: Column | str, boundary: str = SENTENCE_BOUNDARY) -> Column:
        """Like ``functions.text.sentences``, boundaries after abbreviations left out; white space inside a sentence stays."""
        table = InPlanTable(self.entries, "boolean")
        column = F.translate(F.col(text) if isinstance(text, str) else text, MARK, " ")
        # Every boundary is marked and then kept or not, piece by piece.
        marked = F.regexp_replace(F.btrim(column, F.lit(WHITESPACE)), f"({boundary})", f"$1{MARK}")
        pieces = F.split(marked, MARK)

        def last_word(piece: Column) -> Column:
            return F.regexp_extract(F.regexp_extract(piece, r"(\S+)\s*$", 1), WORD, 1)

        def joins(piece: Column, following: Column) -> Column:
            capital = following.rlike(r"^[(\[\"']*\p{Lu}")
            listed = let(F.lower(last_word(piece)), table.lookup)
            return piece.rlike(r"\.\s*$") & F.coalesce(listed | (listed.isNotNull() & ~capital), F.lit(False))

        def ended(all_: Column) -> Column:
            return F.transform(all_, lambda piece, i: F.when(
                (i + 1 < F.size(all_)) & joins(piece, F.get(all_, i + 1)), piece).otherwise(F.concat(piece, F.lit(MARK))))

        whole = F.split(F.array_join(let(pieces, ended), ""), MARK)
        trimmed = F.transform(whole, lambda s: F.btrim(s, F.lit(WHITESPACE)))
        return F.when(column.isNotNull(), F.array_remove(trimmed, ""))


def fit_abbreviations(
    df: DataFrame, text: str, threshold: float = THRESHOLD, max_entries: int = MAX_INLINE_ENTRIES
) -> Abbreviations:
    """Learn from all texts. A fit, so it runs jobs; at most ``max_entries + 1`` words reach the driver."""
    counts = word_counts(df, text).persist()
    try:
        periods, rest = counts.agg(F.sum("with_period"), F.sum("without")).first()
        if not periods or not rest:
            return Abbreviations()
        found = counts.where(F.col("with_period") > 0).where(strength(periods / (periods + rest)) >= threshold)
        names = F.col("capital_after") > F.col("after") * BEFORE_CAPITALS
        rows = found.select("word", names.alias("names")).limit(max_entries + 1).collect()
    finally:
        counts.unpersist()
    if len(rows) > max_entries:
        raise ValueError(f"more than {max_entries} abbreviations; raise the threshold")
    return Abbreviations({r["word"]: r["names"] for r in rows})
