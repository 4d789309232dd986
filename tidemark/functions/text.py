"""Text patterns as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal digits of all scripts, and the ASCII digit of each.
DIGITS = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Nd")
ASCII_DIGITS = "".join(str(unicodedata.digit(c)) for c in DIGITS)

# The written forms that count as week labels, dates, numbers and sentence ends.
# Each starts with a look-ahead for a digit, which turns most positions of a text away at once.
WORD = r"[\p{L}\p{N}_]"
LABEL_OR_DATE = (
    rf"(?=\p{{Nd}})(?<!{WORD})"
    r"\p{Nd}{4}-(?:W\p{Nd}{2}|\p{Nd}{2}-\p{Nd}{2})"
    rf"(?!{WORD})"
)
NUMBER = (
    r"(?=\p{Nd})(?<![A-Za-z0-9.])"
    r"(?:\p{Nd}{1,3}(?:,\p{Nd}{3})+|\p{Nd}+)"
    r"(?:\.\p{Nd}+)?"
    r"(?:[kKmM](?![A-Za-z]))?"
)
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
SENTENCE_END = rf"(?<=[.!?]){SPACE}+(?=[A-Z0-9\"'(])"


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    return F.length(stripped(text)) == 0


def sentence_count(text: Column) -> Column:
    """Sentences end with . ! or ? before white space and a capital, digit, quote or bracket."""
    parts = F.split(stripped(text), SENTENCE_END)
    return F.size(F.filter(parts, lambda p: F.length(p) > 0))


def number_texts(text: Column) -> Column:
    """Array of the numbers written in a text, week labels and ISO dates left out."""
    masked = F.regexp_replace(text, LABEL_OR_DATE, " ")
    return F.regexp_extract_all(masked, F.lit(NUMBER), F.lit(0))


def number_exponent(token: Column) -> Column:
    """Power of ten of the last written digit: 12.34 -> -2, 3k -> 3, 1.2m -> 5."""
    decimals = F.length(F.regexp_extract(token, r"\.(\p{Nd}+)", 1))
    suffix = F.lower(F.right(token, F.lit(1)))
    return F.when(suffix == "k", 3).when(suffix == "m", 6).otherwise(0) - decimals


def number_value(token: Column) -> Column:
    digits = F.translate(F.regexp_replace(token, "[,kKmM]", ""), DIGITS, ASCII_DIGITS).cast("double")
    suffix = F.lower(F.right(token, F.lit(1)))
    return digits * F.when(suffix == "k", 1e3).when(suffix == "m", 1e6).otherwise(1.0)


def number_tolerance(token: Column) -> Column:
    """Half a unit of the last written digit."""
    decimals = F.length(F.regexp_extract(token, r"\.(\p{Nd}+)", 1))
    suffix = F.lower(F.right(token, F.lit(1)))
    scale = F.when(suffix == "k", 1e3).when(suffix == "m", 1e6).otherwise(1.0)
    return F.lit(0.5) * F.pow(F.lit(10.0), -decimals) * scale


def json_object(text: Column) -> Column:
    """From the first { to the last }, NULL when there is no such pair."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(F.length(found) > 0, found)
