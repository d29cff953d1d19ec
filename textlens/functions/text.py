"""Column builders for text: concatenation, sentences, tokens.

None of them leaves the JVM. Sentence splitting, tokenizing and truncation use only expressions
that take part in whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
PLACEHOLDER = "None"
TITLE_BODY_SEPARATOR = " . "
LABEL_SEPARATOR = "|||"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITESPACE = " \t\n\x0b\f\r"

# White space that follows a full stop, exclamation mark or question mark.
SENTENCE_BOUNDARY = r"(?<=[.!?])\s++"
# Starts and ends with something other than ASCII punctuation. Possessive throughout: neighbouring
# parts share no character, so giving characters back could never help and only cost time.
TOKEN = r"[^\s\p{Punct}]++(?:\p{Punct}++[^\s\p{Punct}]++)*+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_text(*columns: Column | str, separator: str = TITLE_BODY_SEPARATOR) -> Column:
    """Join columns, skipping nulls but keeping empty strings; all null gives ``''``."""
    return F.concat_ws(separator, *[_col(c).cast("string") for c in columns])


def placeholder(column: Column | str, value: str = PLACEHOLDER) -> Column:
    """Null and ``''`` become ``value``; anything else becomes its string form."""
    text = _col(column).cast("string")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(value))


def composite_label(*columns: Column | str, separator: str = LABEL_SEPARATOR) -> Column:
    """One label out of several columns; missing parts read ``None`` so positions stay fixed."""
    return F.concat_ws(separator, *[placeholder(c) for c in columns])


def input_text(*columns: Column | str) -> Column:
    """Model input: every column as text, joined by one space, after placeholder filling."""
    return F.concat_ws(" ", *[placeholder(c) for c in columns])


def sentences(text: Column | str, boundary: str = SENTENCE_BOUNDARY) -> Column:
    """Ordered array of non-empty sentences; null stays null, blank text gives an empty array.

    ``boundary`` is the (Java) pattern of the separator that is removed.
    """
    pieces = F.split(F.btrim(_col(text), F.lit(WHITESPACE)), boundary)
    if boundary != SENTENCE_BOUNDARY:
        pieces = F.transform(pieces, lambda s: F.btrim(s, F.lit(WHITESPACE)))
    return F.array_remove(pieces, "")


def tokens(text: Column | str) -> Column:
    """Lower-case words without the ASCII punctuation around them (inner marks stay)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN), F.lit(0))


def truncate_tokens(text: Column | str, n: int) -> Column:
    """The first ``n`` white-space tokens joined by one space.

    The split stops after ``n`` tokens, so the tail of a long text is not tokenized.
    """
    if n <= 0:
        raise ValueError("the number of tokens must be positive")
    head = F.split(F.btrim(_col(text), F.lit(WHITESPACE)), r"\s+", n + 1)
    return F.array_join(F.slice(head, 1, n), " ")
