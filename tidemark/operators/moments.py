"""Timestamps in many notations, precisions and zones as one UTC moment.

A value is first read as clock fields, with its zone if it states one. Values
without a zone need their source's clock. ``zone_evidence`` weighs every
candidate zone of every source: a zone errs where its offset differs from one
that the source itself wrote at that time, and where it would put a moment after
the record's ingestion. ``offset_histories`` takes for each source the history of
zones with the fewest errors, a source being free to move from one zone to
another; a declared clock is the prior that decides between histories of equal
errors. Readings are converted by these histories, and within a zone by its own
history of offsets. Readings and conversions are built-in expressions; only the
search over a source's few months and zones is Python.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import squeeze
from tidemark.session import small

if TYPE_CHECKING:  # loaded in the workers only
    import pandas as pd

#: Zone abbreviations in the feeds and their offsets in minutes.
ABBREVIATIONS = {
    "Z": 0,
    "UT": 0,
    "UTC": 0,
    "GMT": 0,
    "WET": 0,
    "BST": 60,
    "WEST": 60,
    "CET": 60,
    "CEST": 120,
    "EET": 120,
    "EEST": 180,
    "MSK": 180,
    "IST": 330,
    "JST": 540,
    "KST": 540,
    "AEST": 600,
    "AEDT": 660,
    "BRT": -180,
    "EST": -300,
    "EDT": -240,
    "CST": -360,
    "CDT": -300,
    "MST": -420,
    "MDT": -360,
    "PST": -480,
    "PDT": -420,
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_ZONE = r"(Z|[+-]\d{2}:?\d{2}|[A-Z]{2,4})?"
ISO = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)? ?" + _ZONE + r"(?:\[[^\]]*\])?$"
BASIC = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,9}))?)?" + _ZONE + "$"
_CLOCK = r"(?:(?:,|\sat)?\s(\d{1,2}):(\d{2})(?::(\d{2}))?\s?([aApP]\.?[mM]\.?)?\s?" + _ZONE + ")?$"
DAY_MONTH = r"^(?:[A-Za-z]{3,9}\.?,?\s)?(\d{1,2})(?:st|nd|rd|th)?\.?[\s-]([A-Za-z]{3,9})\.?,?[\s-](\d{4})" + _CLOCK
MONTH_DAY = r"^(?:[A-Za-z]{3,9},\s)?([A-Za-z]{3,9})\.?\s(\d{1,2})(?:st|nd|rd|th)?,?\s(\d{4})" + _CLOCK
SLASHED = r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})" + _CLOCK
EPOCH = r"^(?:\d{10}|\d{13}|\d{16}|\d{19})$"
AGE = r"^(\d{1,6})\s?(s|secs?|seconds?|m|mins?|minutes?|h|hrs?|hours?|d|days?|w|wks?|weeks?)(?:\sago)?$"


def read_moments(df: DataFrame, text: str, run_at: str | None = None, day_first: str | None = None, into: str = "m") -> DataFrame:
    """``df`` with a struct ``into (ms, local, off)`` of the timestamp in column ``text``; null if it names no moment.

    ``ms`` is set where the text alone gives the moment (epochs of 10, 13, 16 or
    19 digits; ages, counted back from ``run_at``). Otherwise ``local`` is the
    clock reading as if it were UTC, a timestamp, and ``off`` the stated offset in
    minutes, null if no zone is stated. Two-part dates with slashes follow
    ``day_first`` (month first where it is null), unless only the other order is
    a date. Days that the calendar lacks name no moment.

    The steps are projections of their own, so that each pattern is matched once
    a row, and only the row's own notation is taken apart.
    """
    s = F.col("__s")
    # Year, month, day, hour, minute, second, fraction, half of the day and zone of each notation.
    notations = {
        1: (ISO, "$1|$2|$3|$4|$5|$6|$7||$8"),
        4: (BASIC, "$1|$2|$3|$4|$5|$6|$7||$8"),
        5: (SLASHED, "$3|$1|$2|$4|$5|$6||$7|$8"),
        6: (DAY_MONTH, "$3|$2|$1|$4|$5|$6||$7|$8"),
        7: (MONTH_DAY, "$3|$1|$2|$4|$5|$6||$7|$8"),
    }
    step = df.select(
        "*",
        squeeze(F.col(text)).alias("__s"),
        (F.col(run_at) if run_at else F.lit(None)).cast("timestamp").alias("__run"),
        (F.col(day_first) if day_first else F.lit(None)).cast("boolean").alias("__day_first"),
    )
    kind = F.when(s.rlike(ISO), 1).when(s.rlike(EPOCH), 2).when(s.rlike(AGE_ANY), 3)
    for n, (pattern, _) in notations.items():
        if n > 1:
            kind = kind.when(s.rlike(pattern), n)
    k = F.col("__kind")
    plain = F.lit(None).cast("string")
    for n, (pattern, order) in notations.items():
        plain = F.when(k == n, F.regexp_replace(s, pattern, order)).otherwise(plain)
    step = step.withColumn("__kind", kind).withColumn("__x", F.split(plain, r"\|", -1))

    def part(i: int) -> Column:
        return F.get("__x", F.lit(i))

    def number(x: Column) -> Column:
        return F.when(x != "", x.try_cast("int"))

    short = F.lower(F.substring(part(1), 1, 3))
    named = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), short).cast("int"), F.lit(0))
    one, two = number(part(1)), number(part(2))
    swap = (k == 5) & F.when(two > 12, False).when(one > 12, True).otherwise(F.coalesce("__day_first", F.lit(False)))
    month = F.when(k >= 6, named).when(swap, two).otherwise(one)
    day = F.when(swap, one).otherwise(two)
    h, half = F.coalesce(number(part(3)), F.lit(0)), F.lower(F.substring(part(7), 1, 1))
    hour = F.when(half == "", h).when(h.between(1, 12), h % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.concat(F.when(part(5) == "", "0").otherwise(part(5)), F.lit("."), F.substring(part(6), 1, 6), F.lit("0")).cast("decimal(16,6)")
    local = F.try_make_timestamp(number(part(0)), month, day, hour, F.coalesce(number(part(4)), F.lit(0)), second, F.lit("UTC"))
    zone = part(8)
    figures = F.regexp_replace(zone, "[^0-9]", "")
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    table = F.create_map(*(F.lit(x) for pair in ABBREVIATIONS.items() for x in pair))
    off = (
        F.when(zone == "", None)
        .when(figures != "", sign * (F.substring(figures, 1, 2).try_cast("int") * 60 + F.substring(figures, 3, 2).try_cast("int")))
        .otherwise(F.try_element_at(table, zone))
        .cast("int")
    )
    n, width = s.try_cast("bigint"), F.length(s)
    epoch = F.when(width == 10, n * 1000).when(width == 13, n).when(width == 16, F.floor(n / 1000).cast("bigint")).otherwise(F.substring(s, 1, 13).try_cast("bigint"))
    units = F.create_map(*(F.lit(x) for pair in {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}.items() for x in pair))
    unit = F.lower(F.substring(F.regexp_extract(s, AGE_ANY, 2), 1, 1))
    age = F.unix_millis("__run") - F.regexp_extract(s, AGE_ANY, 1).try_cast("bigint") * F.try_element_at(units, unit) * 1000
    step = (
        step.withColumn("__local", F.when(F.col("__x").isNotNull(), local))
        .withColumn("__off", F.when(F.col("__x").isNotNull(), off))
        .withColumn("__ms", F.when(k == 2, epoch).when(k == 3, age))
    )
    known = F.col("__ms").isNotNull() | (F.col("__local").isNotNull() & ((zone == "") | F.col("__off").isNotNull()))
    m = F.when(known, F.struct(F.col("__ms").alias("ms"), F.col("__local").alias("local"), F.col("__off").alias("off")))
    return step.withColumn(into, m).drop("__s", "__run", "__day_first", "__kind", "__x", "__local", "__off", "__ms")


AGE_ANY = "(?i)" + AGE


def resolve(moment: Column, zone: Column) -> Column:
    """Milliseconds since 1970 of a struct of ``read_moments``, rounded down.

    Readings without a zone are taken on the clock ``zone`` (a zone name): of a
    time that came twice the earlier moment, a skipped one counts on from before
    the change.
    """
    local = moment["local"]
    stated = F.unix_micros(local) - moment["off"].cast("bigint") * 60_000_000
    own = F.unix_micros(F.to_utc_timestamp(local, zone))
    us = F.when(moment["off"].isNotNull(), stated).otherwise(own)
    return F.coalesce(moment["ms"], F.floor(us / 1000).cast("bigint"))


def zone_evidence(rows: DataFrame, zones: list[str]) -> DataFrame:
    """``(source, period, zone, errors, told)``: how often each candidate zone contradicts a source in each calendar month.

    ``rows`` has ``source``, ``m`` (of ``read_moments``) and ``seen`` (timestamp of
    ingestion, may be null). Stated offsets other than 0 are the source's own
    clock (feeds write UTC for technical reasons) and are counted per source,
    day and offset before the candidates are set against them; readings
    without a zone count per source, hour and lag.
    """
    stated = (
        rows.filter("m.local is not null and m.off is not null and m.off != 0")
        .groupBy("source", F.date_trunc("day", "m.local").alias("at"), F.col("m.off").alias("off"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("lag", F.lit(None).cast("bigint"))
    )
    open_ = (
        rows.filter("m.local is not null and m.off is null and seen is not null")
        .groupBy(
            "source",
            F.date_trunc("hour", "m.local").alias("at"),
            F.floor((F.unix_seconds("seen") - F.unix_seconds("m.local")) / 900).alias("lag"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("off", F.lit(None).cast("int"))
    )
    facts = stated.unionByName(open_).withColumn("zone", F.explode_outer(F.array(*map(F.lit, zones))))
    noon = F.when(F.col("off").isNotNull(), F.col("at") + F.expr("interval 12 hours")).otherwise(F.col("at"))
    shift = (F.unix_seconds(F.to_timestamp(noon)) - F.unix_seconds(F.to_utc_timestamp(noon, F.col("zone")))) / 60
    # On the day of a change either offset may be right.
    near = F.abs(shift - F.col("off")) > 60
    exact = shift != F.col("off")
    border = (
        F.unix_seconds(F.to_utc_timestamp(F.col("at") + F.expr("interval 1 day"), F.col("zone")))
        - F.unix_seconds(F.to_utc_timestamp(F.col("at"), F.col("zone")))
    ) != 86400
    wrong = F.when(F.col("off").isNotNull(), F.when(border, near).otherwise(exact)).otherwise(
        F.col("lag") * 15 + 15 + shift < 0
    )
    return (
        facts.select("source", F.trunc(F.col("at").cast("date"), "month").alias("period"), "zone", "n", "off", wrong.alias("wrong"))
        .groupBy("source", "period", "zone")
        .agg(
            F.sum(F.when(F.col("wrong"), F.col("n")).otherwise(0)).alias("errors"),
            F.sum(F.when(F.col("off").isNotNull(), F.col("n")).otherwise(0)).alias("told"),
        )
    )


#: Errors that one more move of a source must spare: stray readings move no source.
MOVE_COST = 5


def _history(pdf: pd.DataFrame) -> pd.DataFrame:
    """The cheapest path of one source through its months: errors and moves first, then months off the prior zone."""
    import numpy as np
    import pandas as pd

    errors = pdf.pivot_table(index="period", columns="zone", values="errors", aggfunc="sum", fill_value=0).sort_index()
    prior = pdf["prior"].iloc[0]
    zones = sorted(errors.columns, key=lambda z: (z != prior, z))
    cost = errors[zones].to_numpy(np.int64)
    other = np.array([z != prior for z in zones], np.int64)
    # one number for both: months off the prior are fewer than ``unit``
    unit = len(cost) + 1
    total, came = cost[0] * unit + other, []
    for row in cost[1:]:
        stay, jump = np.arange(len(zones)), int(total.argmin())
        moved = total > total[jump] + MOVE_COST * unit
        came.append(np.where(moved, jump, stay))
        total = np.where(moved, total[jump] + MOVE_COST * unit, total) + row * unit + other
    path = [int(total.argmin())]
    for back in reversed(came):
        path.append(int(back[path[-1]]))
    path.reverse()
    told = pdf.groupby("period")["told"].max().sort_index().to_numpy()
    starts = [0, *(i for i in range(1, len(path)) if path[i] != path[i - 1])]
    out = []
    for a, b in zip(starts, [*starts[1:], len(path)], strict=True):
        since = errors.index[a] if a else None
        until = errors.index[b] if b < len(path) else None
        out.append((pdf["source"].iloc[0], since, until, zones[path[a]], prior, int(cost[a:b, path[a]].sum()), int(told[a:b].sum())))
    return pd.DataFrame(out, columns=["source", "since", "until", "zone", "prior", "errors", "told"])


def offset_histories(evidence: DataFrame, declared: DataFrame, default: str = "UTC") -> DataFrame:
    """``(source, since, until, zone, declared, errors, told)``: the zones each source of ``evidence`` used, in order of time.

    A zone holds for readings from the month ``since`` (null: from ever) to before
    the month ``until`` (null: for ever). A source's history is the one with the
    fewest errors, a move counting as ``MOVE_COST`` of them; among equal histories
    the one that keeps longest to the zone of ``declared`` (``source, tz``), or to
    ``default`` for a source that is not listed there. A source has as many rows
    as months and zones, however many readings it has.
    """
    listed = declared.filter("source is not null").groupBy("source").agg(F.min("tz").alias("tz")).withColumnRenamed("source", "listed")
    joined = evidence.join(small(listed), F.col("source") == F.col("listed"), "left")
    rows = joined.select("source", "period", "zone", "errors", "told", F.coalesce("tz", F.lit(default)).alias("prior"))
    kind = "source string, since date, until date, zone string, prior string, errors bigint, told bigint"
    found = rows.groupBy("source").applyInPandas(_history, kind)
    named = found.join(small(listed), F.col("source") == F.col("listed"), "left")
    return named.select("source", "since", "until", "zone", F.col("tz").alias("declared"), "errors", "told")


def place(readings: DataFrame, histories: DataFrame, declared: DataFrame, default: str = "UTC") -> DataFrame:
    """``readings`` (``source, m``) with ``zone``, the one their source used at the time of the reading.

    A source without a history uses its declared zone, else ``default``. Each
    reading comes out once.
    """
    month = F.trunc(F.col("m.local").cast("date"), "month")
    h = histories.select(F.col("source").alias("h_source"), "since", "until", F.col("zone").alias("h_zone"))
    d = declared.filter("source is not null").groupBy("source").agg(F.min("tz").alias("d_zone")).withColumnRenamed("source", "d_source")
    within = (F.col("since").isNull() | (month >= F.col("since"))) & (F.col("until").isNull() | (month < F.col("until")))
    joined = readings.join(small(h), F.col("source").eqNullSafe(F.col("h_source")) & within, "left").join(small(d), F.col("source") == F.col("d_source"), "left")
    return joined.select(readings["*"], F.coalesce("h_zone", "d_zone", F.lit(default)).alias("zone"))
