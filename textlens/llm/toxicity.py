"""Toxicity by noisy-channel deobfuscation and learned word evidence.

Restoring. A suspicious stretch (letters mixed with look-alike digits and signs or with separators, single letters or
look-alikes set apart by spaces or dots, letters repeated three times and more) opens a lattice: each position may stand for
itself, for the letters it looks like, for nothing or the end of a word (separators), or a run for one or two of its
letters. Viterbi finds the cheapest path under a character trigram model of the corpus plus the cost of each disguise.
Stretches are read whole, however long, runs of more than ``RUN`` equal characters as so many. All words found are added
to the words as written.

Scoring. Evidence is a word, or the stem (first 4 to 6 letters) of one, that stands in toxic training
texts more often than chance allows: its likelihood ratio statistic must pass a bound that counts
all candidates tried. A text's evidence is the sum over its distinct words of the strongest smoothed
log odds among the word and its stems; a one-variable logistic curve turns it into the score.

The character model is counted over all training documents. Evidence and curve are fitted on at most
``SAMPLE`` labelled training rows, those first in hash order of the id: the documented bound of the
fit. All tables sent to tasks are bounded by it and by the alphabet. Inputs of a score are texts alone.

Defined results: null and empty texts have no evidence and get the curve's base score. Rows are scored one by one;
several labels of an id count as the highest. Without labels every score is the base rate 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textlens.llm.near_dup import saved
from textlens.llm.words import steps

SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
STEMS = (4, 5, 6)
LEAST_TEXTS = 5
CHANCE = 0.01
# Characters taken for letters (fixed values).
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
SEPARATORS = " .-_*"
SWAP, DROP, CUT = 1.0, 0.5, 0.3  # cost of a look-alike, a separator (left out or a word's end), a shortened run
# Look-alikes that also end words as punctuation.
ENDS = "!+("
_SIGNS = re.escape("".join(LOOKS_LIKE))
_TRAILING = re.escape("".join(c for c in LOOKS_LIKE if c not in ENDS))
# Letters set apart: the whole stretch. Otherwise the place that gives a disguise away; the stretch is what
# stands around it up to white space.
_LETTER = r"[^\W\d_]"
_ONE = rf"(?:{_LETTER}|[{_SIGNS}])"
SPACED = re.compile(rf"(?<!{_LETTER}){_ONE}(?:[ .\-_*]{{1,3}}{_ONE}){{2,}}(?!{_LETTER})")
_ANY = rf"[{_SIGNS}.\-_*]"
GIVEAWAYS = (
    # l00kal1ke, in-ner, lookalik3, 1ookalike; the character comes first, as that is faster to search for.
    re.compile(
        rf"{_ANY}(?:(?<={_LETTER}.)(?:{_ANY}*(?={_LETTER})|[{_TRAILING}.\-_*]*(?<=[{_TRAILING}])(?!\w))"
        rf"|(?<!\w.)(?:(?<=[{_SIGNS}]){_ANY}*|{_ANY}*[{_SIGNS}]{_ANY}*)(?={_LETTER}))"
    ),
    re.compile(rf"({_LETTER})\1\1+"),  # repeeeated
)
RUN = 3
_RUNS = re.compile(rf"(.)\1{{{RUN},}}", re.S)
_REST = re.compile(r"\S*")
# Stretches up to this length are kept with what they hide.
KEPT = 80
# No word is longer.
LONGEST = 40
WORD = re.compile(r"[^\W\d_]+")

# The alphabet of the character model: other, boundary, a-z, and the Latin letters up to U+017F.
_LETTERS = [chr(c) for c in range(0x180) if chr(c).isalpha() and chr(c) == chr(c).lower()]
_PLACE = {c: k + 2 for k, c in enumerate(_LETTERS)}
SIZE = len(_LETTERS) + 2
_LOOKUP = np.ones(0x180, np.int64)
for _c in range(0x180):
    _low = chr(_c).lower()
    if _low in _PLACE:
        _LOOKUP[_c] = _PLACE[_low]


def held_out(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(f"  {text} ".encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 0x180, _LOOKUP[np.minimum(points, 0x17F)], 0)


def _trigrams(text: str):
    def run(batches):
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            texts = [t for t in batch.column(text).to_pylist() if t]
            for part in steps([len(t) for t in texts]):
                c = _codes("  ".join(texts[part]))
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["gram", "n"])

    return run


def suspicious(text: str) -> Iterator[str]:
    """Stretches that may hide words, each once, long runs cut to ``RUN``."""
    for match in SPACED.finditer(text):
        if WORD.search(match[0]):
            yield _RUNS.sub(r"\1" * RUN, match[0])
    seen = set()
    for pattern in GIVEAWAYS:
        done = 0
        for match in pattern.finditer(text):
            low, high = match.span()
            if low < done:
                continue
            while low > done and not text[low - 1].isspace():
                low -= 1
            done = _REST.match(text, high).end()
            if low not in seen:
                seen.add(low)
                yield _RUNS.sub(r"\1" * RUN, text[low:done].strip(SEPARATORS + ",;:?\"'#%&*"))


class CharacterModel:
    """log P(c | a b), interpolated from trigram, bigram and single counts."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        two, one = three.sum(0), three.sum((0, 1))
        flat = (one + 1) / (one.sum() + SIZE)
        pair = (two + 5 * flat) / (two.sum(1, keepdims=True) + 5)
        self.cost = -np.log((three + 5 * pair[None]) / (three.sum(2, keepdims=True) + 5)).astype(np.float32)

    @classmethod
    def of(cls, texts: DataFrame, text: str) -> CharacterModel:
        rows = texts.select(text).mapInArrow(_trigrams(text), "gram long, n long").groupBy("gram").agg(F.sum("n"))
        counts = np.zeros(SIZE**3, np.int64)
        for gram, n in rows.collect():  # at most SIZE^3 rows
            counts[gram] = n
        return cls(counts)


def _options(token: str, i: int) -> Iterator[tuple[str, int, float]]:
    """(letters, next position, cost) of what may stand at position i."""
    c = token[i]
    run = i + 1
    while run < len(token) and token[run] == c:
        run += 1
    if c.isalpha():
        yield c, i + 1, 0.0
        if run - i > 1:
            yield c, run, CUT
        if run - i > 2:
            yield c + c, run, 2 * CUT
    for letter in LOOKS_LIKE.get(c, ""):
        yield letter, i + 1, SWAP
        if run - i > 1:
            yield letter, run, SWAP + CUT
    if c in SEPARATORS:
        yield "", i + 1, DROP
        yield " ", run, DROP
    elif c in ENDS:
        yield " ", run, 2 * SWAP
    elif not c.isalnum() and c not in LOOKS_LIKE:
        yield " ", run, 0.0
    if not c.isalpha():
        yield "", run, 8 * SWAP


def restore(token: str, model: CharacterModel) -> str:
    """The likeliest plain words behind a disguised stretch, set apart by spaces (Viterbi over the lattice)."""
    token = token.lower()
    # State: the last two characters; value: cost, letters of the last step, value before it.
    best: list[dict[tuple[int, int], tuple]] = [{} for _ in range(len(token) + 1)]
    best[0][1, 1] = (0.0, "", None)
    cost = model.cost.item
    for i in range(len(token)):
        if not best[i]:
            continue
        options = [(s, [_PLACE.get(c, 1 if c == " " else 0) for c in s], best[to], price) for s, to, price in _options(token, i)]
        for (a, b), path in best[i].items():
            for letters, places, there, price in options:
                x, y, total = a, b, path[0] + price
                for z in places:
                    total += cost(x, y, z)
                    x, y = y, z
                held = there.get((x, y))
                if held is None or total < held[0]:
                    there[x, y] = (total, letters, path)
        best[i] = {}
    ends = [(path[0] + (0.0 if b == 1 else cost(a, b, 1)), k, path) for k, ((a, b), path) in enumerate(best[-1].items())]
    if not ends:
        return token
    path, out = min(ends)[2], []
    while path is not None:
        out.append(path[1])
        path = path[2]
    return " ".join("".join(reversed(out)).split())


def readings(token: str, model: CharacterModel) -> list[str]:
    """The words of a stretch. Where letters are set apart any of them may begin a word, as the ends are hidden too."""
    plain = restore(token, model).split()
    if SPACED.search(token):
        joined = "".join(plain)
        plain += [joined[k : k + LONGEST] for k in range(len(joined) - min(STEMS) + 1)]
    return plain


class Reader:
    """Distinct words of a text, disguised ones restored. Results are kept for repeated stretches."""

    def __init__(self, model: CharacterModel):
        self.model, self.known = model, {}

    def words(self, text: str | None) -> set[str]:
        low = (text or "").lower()
        found = set(WORD.findall(low))
        for token in suspicious(low):
            plain = self.known.get(token)
            if plain is None:
                plain = readings(token, self.model)
                if len(token) <= KEPT:
                    if len(self.known) > 100_000:
                        self.known.clear()
                    self.known[token] = plain
            found.update(plain)
        return found


def features(word: str) -> Iterator[str]:
    """The word itself and its stems."""
    yield word
    for n in STEMS:
        if len(word) >= n:
            yield word[:n] + "*"


def _feature_counts(model: CharacterModel, text: str, only: frozenset[str] | None):
    def run(batches):
        reader, counts = Reader(model), Counter()
        for batch in batches:
            for t in batch.column(text).to_pylist():
                found = {f for w in reader.words(t) for f in features(w)}
                counts.update(found if only is None else found & only)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"]
        )

    return run


def _counted(rows: DataFrame, model: CharacterModel, text: str, only: frozenset[str] | None, least: int) -> dict[str, int]:
    sent = rows.select(text).mapInArrow(_feature_counts(model, text, only), "feature string, n long")
    return dict(tuple(r) for r in sent.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect())


def _term(observed: float, expected: float) -> float:
    return observed * math.log(observed / expected) if observed else 0.0


def evidence(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Features that separate better than chance, with their smoothed log odds."""
    bound = 2 * math.log(max(len(toxic), 1) / CHANCE)
    share = n_toxic / max(n_toxic + n_clean, 1)
    kept = {}
    for feature, k in toxic.items():
        other = clean.get(feature, 0)
        seen = k + other
        ratio = 2 * (_term(k, seen * share) + (_term(other, seen * (1 - share)) if other else 0.0))
        odds = math.log((k + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_clean + 1))
        if odds > 1 and ratio > bound:
            kept[feature] = odds
    return kept


class Judge:
    """A fitted scorer: character model, evidence and logistic curve."""

    def __init__(self, model: CharacterModel, weights: dict[str, float], slope: float, base: float):
        self.model, self.weights, self.slope, self.base = model, weights, slope, base

    def evidence(self, reader: Reader, text: str | None) -> float:
        get = self.weights.get
        total = 0.0
        for word in sorted(reader.words(text)):
            total += max((get(f, 0.0) for f in features(word)), default=0.0)
        return total

    def column(self, text: str, name: str, curve: bool):
        def run(batches):
            reader = Reader(self.model)
            for batch in batches:
                x = np.array([self.evidence(reader, t) for t in batch.column(text).to_pylist()], np.float64)
                values = 1 / (1 + np.exp(-np.clip(self.base + self.slope * x, -40, 40))) if curve else x
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, name])

        return run

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """Documents with a score between 0 and 1; a column of that name is replaced."""
        docs = docs.drop(name)
        return docs.mapInArrow(self.column(text, name, True), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve, by Newton steps with a weak prior on the slope."""
    slope, base = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(base + slope * x, -40, 40)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - y) * x).sum() + 0.05 * slope, (p - y).sum() + 0.05 * base])
        hessian = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 0.05]])
        step = np.linalg.solve(hessian, gradient)
        slope, base = slope - step[0], base - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(base)


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, id_column: str = "doc_id", text: str = "text",
    label: str = "toxic", sample: int = SAMPLE,
) -> Judge:
    """Fit on labelled rows for which ``train`` (a condition on the id) holds."""
    slim = docs.select(id_column, text).where(train)
    model = CharacterModel.of(slim, text)
    chosen = labels.where(train & F.col(label).isNotNull()).groupBy(id_column).agg(F.max(label).cast("int").alias("__label"))
    chosen = chosen.orderBy(F.xxhash64(id_column), id_column).limit(sample)
    held = slim.join(F.broadcast(chosen), id_column)  # at most ``sample`` ids
    rows = saved(held.select(F.col(text).alias("text"), "__label", F.xxhash64(id_column).alias("__id")))
    toxic_rows, clean_rows = rows.where("__label = 1"), rows.where("__label = 0")
    toxic = _counted(toxic_rows, model, "text", None, LEAST_TEXTS)
    clean = _counted(clean_rows, model, "text", frozenset(toxic), 1)
    judge = Judge(model, evidence(toxic, clean, toxic_rows.count(), clean_rows.count()), 0.0, -40.0)
    seen = rows.mapInArrow(judge.column("text", "x", False), "text string, __label int, __id long, x double").select("__id", "x", "__label")
    # One row for each id, so that at most ``sample`` rows are collected however often an id occurs.
    seen = seen.groupBy("__id", "__label").agg(F.max("x").alias("x")).select("x", "__label").collect()
    if seen:
        judge.slope, judge.base = _curve(np.array([r[0] for r in seen]), np.array([float(r[1]) for r in seen]))
    return judge
