"""Lexicon scoring with the published valence rules, as column expressions.

On top of the plain valence sum: degree words before a hit strengthen or weaken it, negations in the
three words before it turn it, capitals among ordinary words stress it, ``but`` shifts the weight to
what follows, and exclamation and question marks amplify the total (Hutto & Gilbert 2014). The word
lists are parameters. Idioms of several words are not part of the rules, but for degree phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from textlens.functions.lexicon import InPlanTable, Lexicon, MAX_INLINE_ENTRIES
from textlens.functions.scores import let
from textlens.functions.text import ASCII_PUNCTUATION, WHITESPACE

# Fixed values of the published rules.
STRENGTHENING = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly",
    "deeply", "effing", "enormous", "enormously", "entirely", "especially", "exceptional",
    "exceptionally", "extreme", "extremely", "fabulously", "flipping", "flippin", "frackin",
    "fracking", "fricking", "frickin", "frigging", "friggin", "fully", "greatly", "hella", "highly",
    "hugely", "incredible", "incredibly", "intensely", "major", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly",
    "total", "totally", "tremendous", "tremendously", "uber", "unbelievably", "unusually", "utter",
    "utterly", "very",
)
WEAKENING = (
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginal",
    "marginally", "occasional", "occasionally", "partly", "scarce", "scarcely", "slight", "slightly",
    "somewhat", "sorta", "sortof", "sort-of",
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont", "hadnt",
    "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "neednt", "never", "none", "nope",
    "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "uh-uh", "wasnt",
    "werent", "without", "wont", "wouldnt", "rarely", "seldom", "despite",
)
WEAKENING_PHRASES = (("kind", "of"), ("sort", "of"), ("just", "enough"))
DEGREE = 0.293
CAPITALS = 0.733
NEGATED = -0.74
DAMPING = (1.0, 0.95, 0.9)
NEVER_SO = 1.25
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96


def default_degrees() -> dict[str, float]:
    return dict.fromkeys(STRENGTHENING, DEGREE) | dict.fromkeys(WEAKENING, -DEGREE)


@dataclass(frozen=True)
class Rules:
    degrees: Mapping[str, float] = field(default_factory=default_degrees)
    negations: Sequence[str] = NEGATIONS
    weakening_phrases: Sequence[tuple[str, str]] = WEAKENING_PHRASES
    contrast: str = "but"


def raw_words(text: Column) -> Column:
    """White-space words in their own case, bare of outer punctuation; short ones (``:)``) stay whole."""
    def bare(word: Column) -> Column:
        return let(
            F.btrim(word, F.lit(ASCII_PUNCTUATION)),
            lambda core: F.when(F.length(core) <= 2, word).otherwise(core),
        )

    return F.transform(F.split(F.btrim(text, F.lit(WHITESPACE)), r"\s+"), bare)


def is_capital(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


# Words the rules ask for by name, besides the word lists.
NAMED = ("no", "or", "nor", "never", "so", "this", "without", "doubt", "least", "at", "very", "kind", "of")
ENTRY_TYPE = "struct<low:string,valence:double,degree:double,negation:boolean>"


class RuleLexicon(Lexicon):
    """A lexicon scored with the rules; used like a ``Lexicon``.

    One table holds every word that matters to a rule, so each word of a text is looked up once.
    Anything else is worked out only around the hits.
    """

    def __init__(self, entries: Mapping[str, float], rules: Rules = Rules(), max_entries: int = MAX_INLINE_ENTRIES):
        super().__init__(entries, max_entries)
        self.rules = rules
        phrased = {word for phrase in rules.weakening_phrases for word in phrase}
        words = {*self.entries, *rules.degrees, *rules.negations, *NAMED, *phrased, rules.contrast}
        self.known = InPlanTable(
            {
                word: {
                    "low": word, "valence": self.entries.get(word), "degree": rules.degrees.get(word),
                    "negation": word in rules.negations,
                }
                for word in words
            },
            ENTRY_TYPE,
        )

    def _hit_valence(self, words: Column, known: Column, i: Column, mixed: Column) -> Column:
        """Valence of the i-th word, a hit, in the light of the three words before it.

        ``mixed``: the text has words that are not in capitals, so that capitals mean something.
        """
        word, following = F.get(known, i), F.get(known, i + F.lit(1))

        def back(d: int) -> Column:
            return F.get(known, i - F.lit(d))

        def said(d: int, *options: str) -> Column:
            return F.coalesce(back(d)["low"].isin(*options), F.lit(False))

        def negation(d: int) -> Column:
            listed = F.coalesce(back(d)["negation"], F.lit(False))
            return listed | F.lower(F.get(words, i - F.lit(d))).contains("n't")

        def stress(value: Column, d: int) -> Column:
            push = F.when(value > 0, F.lit(CAPITALS)).otherwise(F.lit(-CAPITALS))
            stressed = F.when(mixed, push).otherwise(0.0)
            return F.when(is_capital(F.get(words, i - F.lit(d))), stressed).otherwise(0.0)

        def after_neighbour(value: Column, d: int) -> Column:
            """The neighbour d words back, unless it is a lexicon word itself."""
            def stepped(value: Column) -> Column:
                # A degree word pushes away from zero when it strengthens, towards zero when not.
                degree = F.when(value < 0, -back(d)["degree"]).otherwise(back(d)["degree"])
                pushed = value + (degree + stress(value, d)) * DAMPING[d - 1]
                return F.when(back(d)["degree"].isNull(), value).otherwise(pushed)

            if d == 1:
                factor = F.when(negation(d), NEGATED)
            else:
                between = ("so", "this")
                emphatic = said(d, "never") & self._any(said(k, *between) for k in range(1, d))
                doubtless = said(d, "without") & self._any(said(k, "doubt") for k in range(1, d))
                factor = F.when(emphatic, NEVER_SO).when(doubtless, 1.0).when(negation(d), NEGATED)
            changed = stepped(value) * factor.otherwise(1.0)
            if d == 3:
                for first, second in self.rules.weakening_phrases:
                    for at in (3, 2):
                        found = said(at, first) & said(at - 1, second)
                        changed = changed - F.when(found, DEGREE).otherwise(0.0)
            return F.when((i >= d) & back(d)["valence"].isNull(), changed).otherwise(value)

        announces = (word["low"] == "no") & following["valence"].isNotNull()
        refused = said(1, "no") | said(2, "no") | (said(3, "no") & said(1, "or", "nor"))
        value = F.when(announces, 0.0).otherwise(word["valence"])
        value = F.when(refused, word["valence"] * NEGATED).otherwise(value)
        least = said(1, "least") & back(1)["valence"].isNull() & ~said(2, "at", "very")

        scored = let(value, lambda v: let(
            v + stress(v, 0), lambda v: let(
                after_neighbour(v, 1), lambda v: let(
                    after_neighbour(v, 2), lambda v: let(
                        after_neighbour(v, 3), lambda v: v * F.when(least, NEGATED).otherwise(1.0))))))
        hedge = (word["low"] == "kind") & F.coalesce(following["low"] == "of", F.lit(False))
        return F.when(word["degree"].isNotNull() | hedge, 0.0).otherwise(scored)

    @staticmethod
    def _any(conditions) -> Column:
        first, *rest = list(conditions)
        for other in rest:
            first = first | other
        return first

    def keys(self, text: Column) -> Column:
        return F.transform(raw_words(text), lambda word: F.lower(word))

    def valence_sum(self, text: Column) -> Column:
        return self._summed(text, lambda words: F.transform(words, lambda word: let(F.lower(word), self.known.lookup)))

    def valence_sum_of(self, text: Column, values: Column) -> Column:
        """Rule words come from the plan, valences from outside."""
        def entry(word: Column, value: Column) -> Column:
            def joined(low: Column, rule: Column) -> Column:
                row = F.struct(
                    low.alias("low"), value.alias("valence"), rule["degree"].alias("degree"),
                    F.coalesce(rule["negation"], F.lit(False)).alias("negation"),
                )
                return F.when(rule.isNotNull() | value.isNotNull(), row)

            return let(F.lower(word), lambda low: let(self.known.lookup(low), lambda rule: joined(low, rule)))

        return self._summed(text, lambda words: F.zip_with(words, values, entry))

    def _summed(self, text: Column, known_of: Callable[[Column], Column]) -> Column:
        def over(words: Column, known: Column) -> Column:
            places = F.transform(known, lambda k, i: F.when(k["valence"].isNotNull(), i))
            turn = F.array_position(F.transform(known, lambda k: k["low"]), self.rules.contrast)

            mixed = F.exists(words, lambda word: ~is_capital(word))

            def weighted(turn: Column, mixed: Column) -> Column:
                def one(i: Column) -> Column:
                    place = i + 1
                    weight = (
                        F.when((turn == 0) | (place == turn), 1.0)
                        .when(place < turn, BEFORE_CONTRAST).otherwise(AFTER_CONTRAST)
                    )
                    return self._hit_valence(words, known, i, mixed) * weight

                return F.transform(F.array_compact(places), one)

            values = let(turn, lambda t: let(mixed, lambda m: weighted(t, m)))
            return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)

        questions = marks(text, "?")
        emphasis = F.least(marks(text, "!"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION + (
            F.when(questions > MAX_QUESTIONS, MANY_QUESTIONS)
            .when(questions > 1, questions * QUESTION).otherwise(0.0)
        )
        total = let(raw_words(text), lambda words: let(known_of(words), lambda known: over(words, known)))
        return let(total, lambda x: F.when(x > 0, x + emphasis).when(x < 0, x - emphasis).otherwise(x))
