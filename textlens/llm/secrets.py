"""Secret scans: patterns, and windows of high entropy in strings that could be keys.

Only column expressions. Places come from splitting a text at a pattern: the pieces between matches and
the matches themselves, measured in code points, give every start and end.

Kinds, in the order in which spans that start together are listed: ``assign`` (a value assigned to a
password-like name), ``access`` (access key ids), ``hex`` (long hex runs), ``entropy`` (the method).

Entropy: a candidate is a whole run of key characters of at least ``WINDOW`` with a digit or mixed case in it, less the
pattern spans. The character class of each piece (hex of
one or both cases, capitals, mixed letters and digits, letters that change their case often) sets the threshold. A window of ``WINDOW`` characters slides over it; of
the sum of c * log2(c) over the window's character counts only the terms of the character that leaves
and the one that enters change. The span reaches from the first to the last window above the threshold.
Pieces on the allow list (placeholders, identifiers that are no secrets) are left out; the pattern spans always stay.

Defined results: null text counts as empty and has no spans. Spans that start together are listed by kind; equal spans of
different kinds are both there. Texts of any length are scanned whole. Rows are scanned one by one, so repeated rows need no rule and
an empty table gives an empty result; other columns are kept, added ones replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from textlens.functions.scores import let

ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9]|[A-Za-z]*[a-z][A-Z])[A-Za-z0-9+/_=-]{20,}"
# Character class -> (pattern of the whole piece, bits a character at least).
CLASSES = (
    ("hex", r"^(?=.*[a-f])[0-9a-f]+$", 2.9),
    ("upper hex", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", 2.9),
    ("any hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.2),
    ("capitals", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+=*$", 3.4),
    ("mixed", r"^(?=.*[0-9])(?=.*[A-Za-z]).+$", 3.7),
    # Names in camel case change less often and rarely have capitals side by side.
    ("letters", r"^(?=(?:.*?[a-z][A-Z]){3})(?=.*[A-Z]{2})[A-Za-z]+=*$", 3.7),
)
# Characters between a pattern span and what follows.
JOINS = "+/_=-"
ALLOWED = (
    r"(?i)example|sample|placeholder|changeme|xxxx|0123456789|abcdefghij",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]+([-_/=][A-Za-z0-9]{0,4})+$",
    r"^(.)\1+$",
)
SPAN = "struct<start:bigint,rank:int,end:bigint>"
_NONE = f"array<{SPAN}>"


def _span(start: Column, rank: Column, end: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), rank.cast("int").alias("rank"), end.cast("bigint").alias("end"))


def _matches(text: Column, pattern: str, kept=None) -> Column:
    """Array of (start, end, hit) of all matches, in code points. ``kept`` filters by (hit, index)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return F.aggregate(
        F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit"))),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>").alias("out")),
        lambda acc, m: let(
            acc["at"] + m["gap"],
            lambda start: F.struct(
                (start + F.length(m["hit"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct(start.alias("start"), (start + F.length(m["hit"])).alias("end"), m["hit"].alias("hit")))).alias("out"),
            ),
        ),
        lambda acc: acc["out"],
    )


def _found(text: Column, pattern: str, rank: int, probe: str | None = None, extra: Column | None = None) -> Column:
    """Spans of a pattern. Texts without the cheap ``probe`` are not split; ``extra`` flags matches to keep."""
    spans = F.transform(_matches(text, pattern), lambda m: _span(m["start"], F.lit(rank), m["end"]))
    if extra is not None:
        flagged = F.zip_with(spans, extra, lambda s, keep: F.when(keep, s))
        spans = F.filter(flagged, lambda s: s.isNotNull())
    return F.when(text.rlike(probe or pattern), spans).otherwise(F.array().cast(_NONE))


def _term(count: Column) -> Column:
    """c * log2(c) of a small count."""
    table = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]
    return F.get(F.lit(table), count)


def _occurrences(window: Column, character: Column) -> Column:
    return F.size(F.filter(window, lambda c: c == character))


def _most(bits: float) -> float:
    """H = log2(W) - S / W with S the sum of c * log2(c), so the bound on H is one on S."""
    return (math.log2(WINDOW) - bits) * WINDOW + 1e-9


def _hot(candidate: Column, most: Column) -> Column:
    """(first, last): starts of the first and last windows with S up to ``most``; last -1 if none."""

    def step(chars: Column, acc: Column, i: Column) -> Column:
        # 1-based positions: character i enters, character i - WINDOW leaves.
        left = F.get(chars, i - (WINDOW + 1))
        kept = F.slice(chars, F.greatest(i - (WINDOW - 1), F.lit(1)), F.least(i - 1, F.lit(WINDOW - 1)))
        entered = F.get(chars, i - 1)
        gone = F.when(i > WINDOW, let(_occurrences(kept, left), lambda c: _term(c) - _term(c + 1))).otherwise(F.lit(0.0))
        come = let(_occurrences(kept, entered), lambda c: _term(c + 1) - _term(c))
        return let(
            acc["s"] + gone + come,
            lambda s: let(
                (i >= WINDOW) & (s <= most),
                lambda hot: F.struct(
                    s.alias("s"),
                    F.when(hot & (acc["last"] < 0), i - WINDOW).otherwise(acc["first"]).alias("first"),
                    F.when(hot, i - WINDOW).otherwise(acc["last"]).alias("last"),
                ),
            ),
        )

    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("first"), F.lit(-1).alias("last"))
    return let(
        F.split(candidate, ""),
        lambda chars: F.aggregate(F.sequence(F.lit(1), F.length(candidate)), zero, lambda acc, i: step(chars, acc, i)),
    )


def _pieces(m: Column, known: Column) -> Column:
    """Array of (start, end) of what the sorted ``known`` spans leave of a candidate, if long enough."""
    def cut(acc: Column, end: Column) -> Column:
        piece = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.when(end - acc["at"] >= WINDOW, F.concat(acc["out"], piece)).otherwise(acc["out"])

    return F.aggregate(
        F.filter(known, lambda k: (k["start"] < m["end"]) & (m["start"] < k["end"])),
        F.struct(m["start"].alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out")),
        lambda acc, k: F.struct(F.greatest(acc["at"], k["end"]).alias("at"), cut(acc, k["start"]).alias("out")),
        lambda acc: cut(acc, m["end"]),
    )


def _entropy(text: Column, known: Column) -> Column:
    """Spans of high entropy outside the ``known`` ones."""
    def judged(start: Column, piece: Column) -> Column:
        most = F.lit(None).cast("double")
        for _, pattern, bits in reversed(CLASSES):
            most = F.when(piece.rlike(pattern), F.lit(_most(bits))).otherwise(most)
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | piece.rlike(pattern)
        hot = let(most, lambda bound: F.when(bound.isNotNull() & (F.length(piece) >= WINDOW) & ~allowed, _hot(piece, bound)))
        return let(hot, lambda h: F.when(h["last"] >= 0, _span(start + h["first"], F.lit(3), start + h["last"] + WINDOW)))

    def span(m: Column, p: Column) -> Column:
        raw = F.substring(m["hit"], (p["start"] - m["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))
        # Next to a pattern span the joining characters belong to neither.
        return let(
            F.when(p["end"] < m["end"], F.rtrim(raw, F.lit(JOINS))).otherwise(raw),
            lambda right: let(
                F.when(p["start"] > m["start"], F.ltrim(right, F.lit(JOINS))).otherwise(right),
                lambda piece: judged(p["start"] + F.length(right) - F.length(piece), piece),
            ),
        )

    found = _matches(text, CANDIDATE)
    spans = F.flatten(F.transform(found, lambda m: F.transform(_pieces(m, known), lambda p: span(m, p))))
    return F.when(text.rlike(CANDIDATE), F.filter(spans, lambda s: s.isNotNull())).otherwise(F.array().cast(_NONE))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.lit(list(KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans``: arrays of (start, rank of the kind, end), sorted."""
    body = F.col("__body")
    values = F.transform(F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= ASSIGN_VALUE)
    base = F.concat(
        _found(body, ASSIGN, 0, extra=values), _found(body, ACCESS, 1), _found(body, HEX, 2)
    )
    scanned = df.withColumn("__body", F.coalesce(F.col(text), F.lit("")))
    scanned = scanned.withColumn("base_spans", F.sort_array(base))
    scanned = scanned.withColumn("spans", F.sort_array(F.concat("base_spans", _entropy(body, F.col("base_spans")))))
    return scanned.drop("__body")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every found span by ``mark``; texts without one, null included, stay as they are."""
    scanned = scan(df.select(F.struct(*df.columns).alias("__row"), F.col(text).alias("__text")), "__text")
    body = F.col("__text")
    cleaned = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        # A span inside the last one adds nothing; one that overlaps it only lengthens the cut.
        lambda acc, s: F.when(
            s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        ).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), F.length(body))),
    )
    changed = F.when(F.size("spans") > 0, cleaned).otherwise(body)
    columns = [changed.alias(c) if c == text else F.col("__row")[c].alias(c) for c in df.columns]
    return scanned.select(*columns)
