"""Lexicon scoring as pure column expressions.

A lexicon of bounded size travels inside the plan as a constant: an array of small maps, addressed
by ``crc32(token) % buckets``. A lookup therefore costs a handful of comparisons whatever the size
of the lexicon, needs no join, no shuffle and no Python, and the text column is never moved. Larger
lexicons stay tables (``operators.lexicon_values``) that deliver an array of valences for the ``keys`` of a text.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from textlens.functions.scores import let
from textlens.functions.text import tokens

# Normalisation constant of the published valence-to-[-1, 1] formula.
ALPHA = 15.0
COMPOUND_DIGITS = 4

# Largest lexicon carried inside a plan (a few MB); a bigger one must stay a table.
MAX_INLINE_ENTRIES = 50_000
ENTRIES_PER_BUCKET = 2


def compound(valence_sum: Column, alpha: float = ALPHA, digits: int | None = COMPOUND_DIGITS) -> Column:
    """Squash a valence sum into [-1, 1]: ``x / sqrt(x^2 + alpha)``, rounded like the published tool."""
    score = let(valence_sum, lambda x: x / F.sqrt(x * x + F.lit(float(alpha))))
    return score if digits is None else F.round(score, digits)


class InPlanTable:
    """A lookup table that is a constant of the plan: string to a value of a SQL type."""

    def __init__(self, entries: Mapping[str, Any], value_type: str):
        self.entries, self.value_type = dict(entries), value_type
        wanted = max(1, len(self.entries) // ENTRIES_PER_BUCKET)
        self.buckets = 1 << (wanted - 1).bit_length()

    def literal(self) -> Column:
        slots: list[dict[str, Any]] = [{} for _ in range(self.buckets)]
        for key, value in self.entries.items():
            slots[zlib.crc32(key.encode()) % self.buckets][key] = value
        # Parsed once while the plan is optimised; tasks receive the ready-made constant.
        return F.from_json(F.lit(json.dumps(slots)), f"array<map<string,{self.value_type}>>")

    def lookup(self, key: Column) -> Column:
        """The value of a key, null when it is not in the table."""
        slot = F.get(self.literal(), (F.crc32(key.cast("binary")) % self.buckets).cast("int"))
        return F.try_element_at(slot, key)


class Lexicon:
    """An in-plan lexicon: lower-case token to valence."""

    def __init__(self, entries: Mapping[str, float], max_entries: int = MAX_INLINE_ENTRIES):
        if len(entries) > max_entries:
            raise ValueError(
                f"{len(entries)} entries exceed the in-plan limit of {max_entries}; pass a table"
            )
        self.entries = {token.lower(): float(valence) for token, valence in entries.items()}
        if not all(math.isfinite(v) for v in self.entries.values()):
            raise ValueError("valences must be finite numbers")
        self.table = InPlanTable(self.entries, "double")

    @classmethod
    def from_table(
        cls,
        table: DataFrame,
        token: str = "token",
        valence: str = "valence",
        max_entries: int = MAX_INLINE_ENTRIES,
    ) -> Lexicon | None:
        """Read a lexicon table into the plan, or return None when it is larger than the limit.

        At most ``max_entries + 1`` rows reach the driver.
        """
        rows = table.select(token, valence).where(F.col(token).isNotNull()).limit(max_entries + 1)
        found = rows.collect()
        if len(found) > max_entries:
            return None
        entries: dict[str, float] = {}
        for word, value in found:
            if value is not None:
                entries[word.lower()] = max(value, entries.get(word.lower(), value))
        return cls(entries, max_entries=max_entries)

    def valence(self, token: Column) -> Column:
        """Valence of one lower-case token, null when it is not in the lexicon."""
        return self.table.lookup(token)

    def keys(self, text: Column) -> Column:
        """What is looked up of a text, in order."""
        return tokens(text)

    def valence_sum(self, text: Column) -> Column:
        return self.valence_sum_of(text, F.transform(self.keys(text), self.valence))

    def valence_sum_of(self, text: Column, values: Column) -> Column:
        """The sum, given the valence (or null) of each of the text's ``keys``."""
        return F.aggregate(values, F.lit(0.0), lambda total, value: total + F.coalesce(value, F.lit(0.0)))

    def score(self, text: Column, alpha: float = ALPHA, digits: int | None = COMPOUND_DIGITS) -> Column:
        """Compound score of one text; no hits give 0.0 and null text gives null."""
        return compound(self.valence_sum(text), alpha, digits)

    def score_each(self, texts: Column, **options) -> Column:
        """Scores of an array of texts, same length and order."""
        return F.transform(texts, lambda text: self.score(text, **options))


class PhraseLexicon(Lexicon):
    """A lexicon whose entries may have several words. At each place the longest entry counts, and its words for nothing else.

    Keys of a text are its runs of one word, then those of two, and so on, a key for each place (null where the text ends).
    ``longest`` is the number of words of the longest entry; it is found from ``entries`` unless they stay in a table.
    """

    def __init__(self, entries: Mapping[str, float], longest: int | None = None, max_entries: int = MAX_INLINE_ENTRIES):
        super().__init__({" ".join(phrase.split()): value for phrase, value in entries.items()}, max_entries)
        self.longest = longest or max((len(phrase.split()) for phrase in self.entries), default=1)

    def keys(self, text: Column) -> Column:
        def run(words: Column, i: Column, n: int) -> Column:
            return F.when(i + n <= F.size(words), F.array_join(F.slice(words, i + 1, n), " "))

        def runs(words: Column) -> Column:
            return F.concat(words, *[F.transform(words, lambda _, i: run(words, i, n)) for n in range(2, self.longest + 1)])

        return let(tokens(text), runs)

    def valence_sum_of(self, text: Column, values: Column) -> Column:
        def summed(values: Column) -> Column:
            size = F.floor(F.size(values) / self.longest).cast("int")

            def longest_at(i: Column) -> Column:
                """(words, valence) of the longest entry that starts here; null for none."""
                found = None
                for n in range(self.longest, 0, -1):
                    value = F.get(values, size * (n - 1) + i)
                    match = F.struct(F.lit(n).alias("words"), value.alias("valence"))
                    found = F.when(value.isNotNull(), match) if found is None else found.when(value.isNotNull(), match)
                return found

            def step(state: Column, i: Column) -> Column:
                taken = lambda m: F.when(m.isNull() | (i < state["free"]), state).otherwise(
                    F.struct((i + m["words"]).alias("free"), (state["total"] + m["valence"]).alias("total"))
                )
                return let(longest_at(i), taken)

            places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
            start = F.struct(F.lit(0).alias("free"), F.lit(0.0).alias("total"))
            return F.when(values.isNotNull(), F.aggregate(places, start, step, lambda state: state["total"]))

        return let(values, summed)
