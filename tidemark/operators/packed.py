"""Several values packed in one field, split into one row per value.

Quoted spans are taken out first and stand as indexed placeholders in the text,
so that the delimiters within them do not count; the rest is split; the spans
come back by array lookup; the values are exploded with their positions. All
steps are built-in expressions on one row at a time: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import BLANK, strip_blanks

OPEN, CLOSE = "", ""
#: A double-quoted span with doubled or backslashed quotes inside.
SPAN = r'"(?:[^"\\]|\\.|"")*"'
_B = BLANK
#: Delimiters of packed text. A slash or two count between blanks only, a comma only between quoted values.
TEXT_DELIMITERS = (
    rf"[|｜;；\n\r\t•·]|(?:^|(?<={_B}))//?(?={_B}|$)"
    rf"|(?<={CLOSE}){_B}*,{_B}*(?={OPEN})|(?<={CLOSE}){_B}+(?={OPEN})"
)
#: Delimiters of packed addresses, which hold no blanks or commas of their own unless quoted.
ADDRESS_DELIMITERS = (
    rf"(?:^|(?:{_B}|[|｜;；,，•])+)(?:(?i:and)|&|//?)(?={_B}|$)"
    rf"|(?:{_B}|[|｜;；,，•])+"
)


def _unquote(span: Column, json_cell: Column) -> Column:
    """The text of a quoted span; JSON cells follow JSON's escapes, others know doubled and backslashed quotes."""
    inner = F.substring(span, F.lit(2), F.length(span) - 2)
    plain = F.regexp_replace(F.replace(inner, F.lit('""'), F.lit('"')), r'\\(["\\])', "$1")
    parsed = F.try_element_at(F.from_json(F.concat(F.lit("["), span, F.lit("]")), "array<string>"), F.lit(1))
    return F.when(json_cell & parsed.isNotNull(), parsed).otherwise(plain)


def unpack(
    df: DataFrame, key: str, field: str, delimiters: str = TEXT_DELIMITERS, field_name: str | None = None
) -> DataFrame:
    """One row ``(field_name, row_key, pos, val)`` for each value of ``df[field]``.

    ``row_key`` is ``df[key]`` as text. Null, blank and ``nan`` cells give none.
    Values are trimmed; empty ones are dropped and take no position; repeats are
    kept. A cell that is a JSON array of strings is read as one. A quote that is
    never closed is ordinary text. A span with text beside it in its value keeps
    its quotes. The placeholder characters themselves may occur in a cell: they
    are replaced on the way in and restored on the way out. Rows whose key is
    null keep a null key; repeated rows give repeated values; an empty table
    gives an empty result. Columns of ``df`` that bear the result's names do no
    harm.

    Every step is a projection of its own, so that no pattern is matched more
    than once a cell; cells without quotes take the short way.
    """
    text, json_cell, safe = F.col("text"), F.col("json_cell"), F.col("safe")

    def own(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(OPEN + "e" + CLOSE), F.lit(OPEN)), F.lit(OPEN + "f" + CLOSE), F.lit(CLOSE))

    def whole(value: Column) -> Column:
        return F.regexp_extract(value, rf"^{OPEN}(\d+){CLOSE}$", 1)

    def restore(value: Column) -> Column:
        at = whole(value)
        quoted = own(_unquote(F.get("spans", at.cast("int")), json_cell))
        parts = F.split(value, rf"(?={OPEN}\d)|(?<={CLOSE})")
        beside = F.array_join(
            F.transform(parts, lambda p: F.when(whole(p) != "", F.get("spans", whole(p).cast("int"))).otherwise(p)), ""
        )
        return strip_blanks(F.when(at != "", quoted).otherwise(own(beside)))

    def number(p: Column, i: Column) -> Column:
        return F.concat(F.when(i > 0, F.concat(F.lit(OPEN), (i - 1).cast("string"), F.lit(CLOSE))).otherwise(F.lit("")), p)

    step = df.select(F.col(key).cast("string").alias("row_key"), strip_blanks(F.col(field)).alias("text"))
    none = (text == "") | (F.lower(text) == "nan")
    marks = text.contains('"') | text.contains(OPEN) | text.contains(CLOSE)
    step = step.withColumns(
        {
            "short": F.coalesce(~marks & ~(text.startswith("[") & text.endswith("]")), F.lit(False)),
            "json_cell": text.rlike(rf'^\[{_B}*(?:"|\])') & text.endswith("]"),
            "none": F.coalesce(none, F.lit(True)),
        }
    )
    body = F.when(json_cell, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    escaped = F.regexp_replace(
        F.regexp_replace(F.replace(body, F.lit(OPEN), F.lit(OPEN + "\x00")), CLOSE, OPEN + "f" + CLOSE), "\x00", "e" + CLOSE
    )
    step = step.withColumn("safe", F.when(~F.col("short") & ~F.col("none"), escaped))
    step = step.withColumns(
        {
            "spans": F.regexp_extract_all(safe, F.lit(f"({SPAN})"), F.lit(1)),
            "marked": F.array_join(F.transform(F.split(safe, SPAN, -1), number), ""),
        }
    )
    pieces = F.split(F.when(F.col("short"), text).otherwise(F.col("marked")), delimiters, -1)
    step = step.withColumn("pieces", F.when(~F.col("none"), F.filter(F.transform(pieces, lambda v: strip_blanks(v)), lambda v: v != "")))
    values = F.when(F.col("short"), F.col("pieces")).otherwise(F.filter(F.transform("pieces", restore), lambda v: v != ""))
    # The outer form: the inner one would split every cell a second time, in a filter that the optimizer infers.
    out = step.select("row_key", F.posexplode_outer(values).alias("pos", "val"))
    return out.filter("pos is not null").select(F.lit(field_name or field).alias("field_name"), "row_key", "pos", "val")
