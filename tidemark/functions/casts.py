"""Tolerant casts of typed text, dates and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of consent and refusal.
TRUE, FALSE = ("true", "1", "yes", "y"), ("false", "0", "no", "n")


def _word(text: Column) -> Column:
    return F.lower(F.trim(text.cast("string")))


def to_bool(text: Column) -> Column:
    """True for a word of consent, else false; never null."""
    return F.coalesce(_word(text).isin(*TRUE), F.lit(False))


def to_optional_bool(text: Column) -> Column:
    """True, false, or null for anything else."""
    return F.when(_word(text).isin(*TRUE), True).when(_word(text).isin(*FALSE), False)


def to_control(text: Column) -> Column:
    """``controlled``, ``uncontrolled`` or null from booleans and words."""
    return F.when(_word(text).isin("controlled", *TRUE), "controlled").when(_word(text).isin("uncontrolled", *FALSE), "uncontrolled")


def to_rank(text: Column) -> Column:
    """Whole number of a number in text, cut toward zero; null if there is none."""
    return F.trim(text.cast("string")).try_cast("double").try_cast("int")


def to_instant(text: Column) -> Column:
    """ISO 8601 or RFC 2822 text as a timestamp; no zone means UTC."""
    s = F.trim(text)
    rfc = F.regexp_replace(F.regexp_replace(s, r"^[A-Za-z]{3},\s*", ""), r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s.try_cast("timestamp")), F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss xx")))


def mirror(a: Column, b: Column) -> tuple[Column, Column]:
    """Two fields that stand for each other: blanks null, each filled from the other."""
    x, y = F.nullif(F.trim(a), F.lit("")), F.nullif(F.trim(b), F.lit(""))
    return F.coalesce(x, y), F.coalesce(y, x)


def sanitized(value: Column) -> Column:
    """Text of a value; empty for null and for ``nan`` in any case."""
    text = value.cast("string")
    return F.when(text.isNull() | (F.lower(text) == "nan"), "").otherwise(text)


def month_floor(day: Column) -> Column:
    return F.trunc(day, "month")


#: Units of an age; each may stand in the plural, the short ones also right after the number.
UNITS = ("sec", "second", "min", "minute", "hour", "day", "week", "month", "year")
UNIT_LETTERS = "smhdwy"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def looks_like_date(text: Column) -> Column:
    """Whether text tells an age (a number with a unit) or a date (digits by dashes, or a month's name with day and year)."""
    low = F.lower(text)
    age = low.rlike(r"\b\d+\s+(?:" + "|".join(UNITS) + r")s?\b") | low.rlike(r"^\d+\s*[" + UNIT_LETTERS + "]$")
    return age | low.rlike(r"\b\d{4}-\d\d-\d\d\b") | low.rlike(r"\b(?:" + "|".join(MONTHS) + r")[a-z]*\s+\d{1,2},?\s+\d{4}\b")


def json_length(doc: Column, path: str) -> Column:
    """Elements of a JSON array; 0 for objects, scalars and missing paths."""
    return F.coalesce(F.json_array_length(F.get_json_object(doc, path)), F.lit(0))


def json_within(text: Column) -> Column:
    """The outermost braces of a text that holds an object among other words."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
