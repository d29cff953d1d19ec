"""Quality rules: a threshold table compiled into one projection.

Every measure is a Spark expression over the whole text; no user function runs and nothing is
shuffled. ``RULES`` is data: a rule names a ratio and its bounds, ``verdict`` turns the table into
one boolean and the list of broken rules.

Defined results: null text counts as empty; texts without words have all counts 0 and fail the base
rule; a ratio with denominator 0 is 0. Columns of the input other than the text are kept as they
are (measures replace columns of the same name). Rows are judged one by one, so repeated rows give
repeated results and an empty table an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from textlens.functions.scores import let
from textlens.operators.scoring import computed_once
from textlens.llm.words import SPACE_CLASS, words

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Repeated windows up to which positions are looked up instead of sorted; both give the same count.
LOOKED_UP = 64

# Frequent function words of the four languages of the tables (fixed values).
STOP_WORDS = (
    "the of and to in is that for it was on are as with be this by from or an at not have he a "
    "der die das und in zu den von mit ist im für auf eine des dem sich nicht als ein "
    "de la le les et des en un une du que est pour qui dans par sur au pas avec "
    "el los y que las del se por con para una su al es lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a missing bound does not bind."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None

    def broken(self) -> Column:
        bottom = F.col(self.denominator)
        ratio = F.when(bottom > 0, F.col(self.numerator) / bottom).otherwise(F.lit(0.0))
        low = F.lit(False) if self.low is None else ratio < self.low
        high = F.lit(False) if self.high is None else ratio > self.high
        return low | high

    def sql(self) -> str:
        ratio = f"(CASE WHEN {self.denominator} > 0 THEN {self.numerator}::DOUBLE / {self.denominator} ELSE 0 END)"
        bounds = [f"{ratio} < {self.low}"] if self.low is not None else []
        bounds += [f"{ratio} > {self.high}"] if self.high is not None else []
        return " OR ".join(bounds)


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.25),
    Rule("shouting", "n_exclamations", "n_words", high=0.25),
    Rule("stop_words", "n_stop_words", "n_words", low=0.05),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("line_length", "n_words", "n_lines", low=2.0),
)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words",
)


def _count(text: Column, character_class: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, character_class, ""))


def _with_repeats(df: DataFrame, w: str) -> DataFrame:
    """Add ``__repeat_words``: words of array ``w`` in a three-word window found twice or more.

    Windows are compared by 64-bit hashes, in arrays of longs that cost little to sort: within one
    text of n words, two different windows share a hash with odds of n^2 / 2^65.
    """
    words_, h, s, twice = F.col(w), F.col("__h"), F.col("__s"), F.col("__twice")
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words_) - 3), lambda i: F.xxhash64(words_[i], words_[i + 1], words_[i + 2])
    )
    empty = F.array().cast("array<bigint>")
    staged = df.withColumn("__h", F.when(F.size(words_) >= 3, hashes).otherwise(empty))
    staged = staged.withColumn("__s", F.sort_array(h))
    staged = staged.withColumn("__twice", F.array_distinct(F.filter(s, lambda x, k: x == F.get(s, k + 1))))
    # A few repeated windows are looked up for each position; many are found by sorting positions.
    looked_up = F.filter(
        F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull()
    )

    def neighbours(pairs: Column) -> Column:
        same = lambda x, k: x["h"].eqNullSafe(F.get(pairs, k)["h"])
        marked = F.transform(pairs, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    sorted_pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    starts = F.when(F.size(twice) <= LOOKED_UP, looked_up).otherwise(let(sorted_pairs, neighbours))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(3))).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    counted = F.when(F.size(twice) == 0, F.lit(0)).otherwise(covered)
    return staged.withColumn("__repeat_words", counted).drop("__h", "__s", "__twice")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each text as bigint columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    staged = df.withColumns({"__words": words(text), "__lines": lines})
    staged = _with_repeats(staged, "__words")
    w, n = F.col("__words"), F.size("__words")
    stop = F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS)))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace(body, SPACE_CLASS + "+", "")),
        "n_symbols": _count(body, SYMBOLS),
        "n_exclamations": _count(body, "!"),
        "n_stop_words": stop,
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.col("__repeat_words"),
    }
    measured = staged.withColumns({name: value.cast("bigint") for name, value in counts.items()})
    return measured.drop("__words", "__lines", "__repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the measures, ``base_failed``, ``broken_rules`` (names joined by commas) and ``kept``."""
    named = [F.when(rule.broken(), F.lit(rule.name)) for rule in rules]
    judged = measure(df, text).withColumns(
        {"base_failed": base_failed(), "broken_rules": F.concat_ws(",", *named)}
    )
    # A filter on the verdict would be moved below the measures, and all of them be copied into it.
    return computed_once(judged, "kept", ~F.col("base_failed") & (F.col("broken_rules") == ""))


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows the rules keep, with the columns of the input."""
    probe = df.withColumn("__text", F.col(text))
    return judge(probe.select(F.struct(*df.columns).alias("__row"), "__text"), "__text", rules).where("kept").select("__row.*")


def oracle_sql(documents: str = "documents") -> str:
    """DuckDB SQL of ``judge`` over a table with doc_id and text."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    broken = ", ".join(f"CASE WHEN {rule.sql()} THEN '{rule.name}' END" for rule in RULES)
    counts = ", ".join(f"{m}::BIGINT AS {m}" for m in MEASURES)
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {documents}),
    s AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
    p AS (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i FROM s),
    g AS (SELECT rid, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM p
        WINDOW o AS (PARTITION BY rid ORDER BY i)),
    r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
    c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
    m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
        length(t) - length(replace(t, '!', '')) AS n_exclamations,
        len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words, len(l) AS n_lines,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
        FROM s LEFT JOIN c USING (rid)),
    b AS (SELECT doc_id, {counts}, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed,
        concat_ws(',', {broken}) AS broken_rules FROM m)
    SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM b"""
