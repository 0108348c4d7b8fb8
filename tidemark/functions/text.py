"""Unicode folding and tokens as JVM-side column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks beyond ASCII; Java's ``\s`` leaves them out.
BLANK = r"[\s   -     　﻿]"


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Characters of the basic plane that decompose into one letter or digit, and that letter or digit."""
    source, target = [], []
    for code in range(0x80, 0xFFFF):
        char = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or unicodedata.category(char)[0] not in "LN":
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)).lower()
        if len(base) == 1 and base != char and base.isalnum():
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def fold(text: Column) -> Column:
    """Lower case without accents, width forms, combining marks and invisible characters.

    Null stays null. Characters that decompose into several (ligatures) are kept,
    but for the German sharp s, which becomes ``ss``.
    """
    source, target = _fold_table()
    plain = F.translate(F.lower(text), source, target)
    return F.replace(F.regexp_replace(plain, r"[\p{M}\p{Cf}]+", ""), F.lit("ß"), F.lit("ss"))


def words(text: Column) -> Column:
    """Runs of letters and digits of ``fold(text)``; an empty array for a text without any."""
    return F.filter(F.split(fold(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def squeeze(text: Column) -> Column:
    """Trimmed text in which any run of blanks is one space."""
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def strip_blanks(text: Column) -> Column:
    """Text without blanks of any kind at its ends."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


#: The named references met in feeds and what they stand for.
ENTITIES = {
    "&nbsp;": " ",
    "&quot;": '"',
    "&apos;": "'",
    "&lt;": "<",
    "&gt;": ">",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&amp;": "&",
}


def unescape_html(text: Column) -> Column:
    """Named references of ``ENTITIES`` and numeric references of the basic plane resolved."""

    def one(piece: Column, at: Column) -> Column:
        body = F.regexp_extract(piece, r"^([xX][0-9a-fA-F]{1,4}|[0-9]{1,5});", 1)
        code = F.when(
            F.lower(F.substring(body, 1, 1)) == "x", F.conv(F.substring(body, 2, 4), 16, 10).cast("int")
        ).otherwise(body.try_cast("int"))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        known = (body != "") & (code > 0) & (code < 0xD800)
        return (
            F.when(at == 0, piece)
            .when(known, F.concat(char, F.expr("''"), F.substring(piece, F.length(body) + 2, F.length(piece))))
            .otherwise(F.concat(F.lit("&#"), piece))
        )

    out = F.when(text.contains("&#"), F.array_join(F.transform(F.split(text, "&#"), one), "")).otherwise(text)
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    return out
