"""Text normalisation as Catalyst expressions (Column -> Column).

Regular expressions are written so that Java and RE2 read them alike: Unicode
classes are spelled out instead of relying on ``\\w`` and ``\\s``, and the white
space class holds what ``str.isspace`` accepts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\p{Z}\x{85}\x{b}\x{1c}-\x{1f}"
WORD = r"\p{L}\p{N}_\x{600}-\x{6FF}"
TOKEN = rf"[{WORD}]+|[^{SPACE}]"

# Arabic-Indic digits and the ASCII digits they stand for.
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ASCII_DIGITS = "0123456789"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` knows only spaces)."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(c: Column) -> Column:
    """True for null and for text of white space only; never null."""
    return c.isNull() | ~c.rlike(rf"[^{SPACE}]")


def normalize_digits(c: Column) -> Column:
    return F.translate(c, ARABIC_DIGITS, ASCII_DIGITS)


def squeeze(c: Column) -> Column:
    """Every run of white space becomes one space, none at the ends."""
    return strip(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def normalize_whitespace(c: Column) -> Column:
    """Spaces and tabs squeezed, line breaks tightened, ends stripped."""
    c = F.regexp_replace(F.translate(c, "\u00a0", " "), r"[ \t]+", " ")
    return strip(F.regexp_replace(c, rf"[{SPACE}]*\n[{SPACE}]*", "\n"))


def normalize_document_number(c: Column) -> Column:
    """``٥٠ / ٢٠٢٦`` becomes ``50/2026``; null when nothing is left."""
    c = normalize_whitespace(normalize_digits(c))
    c = F.regexp_replace(c, rf"[{SPACE}]*/[{SPACE}]*", "/")
    return F.when(c != "", c)


def normalize_identity(c: Column) -> Column:
    """The form of a value that enters a hash; null becomes empty."""
    c = F.lower(normalize_digits(F.coalesce(c, F.lit(""))))
    c = F.regexp_replace(c, r"[\x{64B}-\x{65F}]", "")
    return squeeze(F.regexp_replace(c, r"[^a-z0-9\x{600}-\x{6FF}/]+", " "))


def normalize_topic_name(c: Column) -> Column:
    """The key form of a topic name; null becomes empty."""
    c = F.lower(normalize_digits(F.coalesce(c, F.lit(""))))
    c = F.regexp_replace(c, r"[\x{64B}-\x{65F}]", "")
    c = F.regexp_replace(c, rf"[^{WORD}{SPACE}]", " ")
    return squeeze(F.regexp_replace(c, "_+", " "))


def tokens(c: Column) -> Column:
    """The tokens of a text, in order; null gives null."""
    return F.regexp_extract_all(c, F.lit(f"({TOKEN})"), F.lit(1))


def token_count(c: Column) -> Column:
    """How many tokens a text has; null and blank texts have 0."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0))


def normalize_kind(c: Column) -> Column:
    """Case and outer white space ignored; blank becomes null."""
    c = F.lower(strip(c))
    return F.when(c != "", c)
