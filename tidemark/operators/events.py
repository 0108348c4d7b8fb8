"""Multi-day events of entities: triggers, evidence, and a state that carries on, as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def triggers(total: Column, neg: Column, prev_total: Column, prev_neg: Column, stories: Column, recent: Column, p: dict[str, int] | None = None) -> dict[str, Column]:
    """Named conditions, compared on integers.

    ``p``: ``stories`` (2), ``total`` (5), ``pct`` (rise of the share in twentieths, 4), ``neg`` (2),
    ``recent`` (2), ``hold`` (share to carry on in twentieths, 10).
    """
    p = {"stories": 2, "total": 5, "pct": 4, "neg": 2, "recent": 2, "hold": 10} | (p or {})
    t0 = F.when(prev_total > 0, prev_total).otherwise(1)
    n0 = F.when(prev_total > 0, prev_neg).otherwise(0)
    rise = 20 * (neg * t0 - n0 * total) >= p["pct"] * total * t0
    delta = (total >= p["total"]) & rise & (neg - prev_neg >= p["neg"]) & (recent >= p["recent"])
    return {
        "top_stories": stories >= p["stories"],
        "newsfeed_delta": delta,
        "continued": (recent >= p["recent"]) & (total > 0) & (20 * neg >= p["hold"] * total),
    }


def event_state(df: DataFrame, keys: list[str], day: str, base: Column, carry: Column, seeds: DataFrame | None = None) -> DataFrame:
    """``df`` with ``active`` and ``continued``.

    A day is active if ``base`` holds, or if the calendar day before was active
    and ``carry`` holds. ``seeds`` gives ``(keys, day, active)`` for the day before the window. Gaps and islands:
    a day is linked to the one before if ``carry`` holds and the days adjoin; runs
    of linked days are active from their first base day on.
    """
    rows = df.withColumn("__b", F.coalesce(base, F.lit(False))).withColumn("__c", F.coalesce(carry, F.lit(False))).withColumn("__seed", F.lit(False))
    if seeds is not None:
        seed = seeds.select(*keys, day, F.col("active").alias("__b")).withColumn("__c", F.lit(False)).withColumn("__seed", F.lit(True))
        rows = rows.unionByName(seed, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(day)
    adjoins = F.coalesce(F.date_diff(F.col(day), F.lag(day).over(w)) == 1, F.lit(False))
    rows = rows.withColumn("__adj", adjoins).withColumn("__run", F.sum(F.when(F.col("__c") & F.col("__adj"), 0).otherwise(1)).over(w))
    inside = Window.partitionBy(*keys, "__run").orderBy(day)
    rows = rows.withColumn("active", F.max("__b").over(inside))
    rows = rows.withColumn("continued", F.coalesce(F.lag("active").over(w), F.lit(False)) & F.col("__adj") & F.col("__c"))
    return rows.filter(~F.col("__seed")).select(*df.columns, "active", "continued")


def evidence_key(url: Column, title: Column, source: Column) -> Column:
    """Lower-case URL, or title and source where there is none."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return F.when(blank(url) != "", F.lower(blank(url))).otherwise(F.lower(F.concat(blank(title), F.lit("::"), blank(source))))


def dedupe_evidence(df: DataFrame, keys: list[str], key: Column, order: list[str]) -> DataFrame:
    """The first row by ``order`` of each evidence key."""
    w = Window.partitionBy(*keys, "__key").orderBy(*order)
    return df.withColumn("__key", key).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "__key")
