"""Scalar column functions; all stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_rate(numerator: Column, denominator: Column) -> Column:
    """Their quotient, 0 for a denominator of 0."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def month_key(stamp: Column) -> Column:
    """``YYYY-MM`` in the session's zone (UTC)."""
    return F.date_format(stamp, "yyyy-MM")


def month_of_text(stamp: Column) -> Column:
    """``YYYY-MM`` of an ISO-8601 text, in the text's own offset."""
    return F.substring(stamp, 1, 7)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 with ``Z`` or an offset; empty texts are null."""
    return F.to_timestamp(F.when(F.trim(text) != "", F.trim(text)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column, floor: float = 1e-12) -> Column:
    length = F.greatest(norm(a), F.lit(floor))
    return F.transform(a, lambda x: x.cast("double") / length)


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda x: x != "")).cast("long")


def dialogue(speaker: Column, sentence: Column) -> Column:
    return F.concat(speaker, F.lit(": "), sentence)


def placeholder(kind: Column, number: Column) -> Column:
    return F.format_string("[%s_%02d]", kind, number)


def valid_card(value: Column) -> Column:
    """13 to 19 digits that pass the Luhn check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


# Patterns of personal data, in the order that breaks ties.
PATTERNS = {
    "EMAIL_ADDRESS": r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "PHONE_NUMBER": r"(?<!\w)(?:\+?\d[\d .()/-]{7,}\d)(?!\w)",
    "CREDIT_CARD": r"(?<!\d)(?:\d[ -]?){13,19}(?!\d)",
    "IP_ADDRESS": r"\b(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}\b",
    "US_SSN": r"\b\d{3}-\d{2}-\d{4}\b",
}


def matches(text: Column, kind: str) -> Column:
    """All values of a kind of personal data; cards are checked."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    return F.filter(found, valid_card) if kind == "CREDIT_CARD" else found


def replace_aliases(text: Column, aliases: Column) -> Column:
    """Fold whole-word, case-insensitive replacements over ``text``.

    ``aliases`` is ``array<struct<surface, token>>``, longest surface first.
    """
    pattern = lambda s: F.concat(F.lit(r"(?iu)(?U)\b\Q"), F.replace(s, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))
    token = lambda t: F.regexp_replace(t, r"([\\$])", r"\\$1")
    return F.aggregate(aliases, text, lambda acc, a: F.regexp_replace(acc, pattern(a["surface"]), token(a["token"])))
