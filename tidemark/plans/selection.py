"""Ranked selection of candidates: gates, pauses, budgets, queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gated(df: DataFrame, gates: list[tuple[str, Column]]) -> DataFrame:
    """``df`` with ``skip_reason``: the name of the first gate that a row fails, null if it passes all."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(gates):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("skip_reason", reason)


def paused(df: DataFrame, history: DataFrame, key: Column, fallback: Column, now: Column, hours: int = 168) -> DataFrame:
    """``df`` with ``last_sent`` and ``paused``: whether its key (else its fallback key) was used within ``hours``."""
    seen = history.groupBy("alert_key").agg(F.max("sent_at").alias("at"))
    a = seen.select(F.col("alert_key").alias("__k"), F.col("at").alias("__a"))
    b = seen.select(F.col("alert_key").alias("__f"), F.col("at").alias("__b"))
    out = df.join(a, key == F.col("__k"), "left").join(b, fallback == F.col("__f"), "left")
    last = F.coalesce("__a", "__b")
    out = out.withColumn("last_sent", last).withColumn("paused", F.coalesce(F.unix_seconds(now) - F.unix_seconds(last) < hours * 3600, F.lit(False)))
    return out.drop("__k", "__f", "__a", "__b")


def budgeted(df: DataFrame, by: list[str], order: list[Column], most: int, used: Column | None = None) -> DataFrame:
    """The first rows of each group in order, as many as the budget leaves."""
    w = Window.partitionBy(*by).orderBy(*order)
    left = F.lit(most) - (F.coalesce(used, F.lit(0)) if used is not None else F.lit(0))
    ranked = df.withColumn("rank", F.row_number().over(w))
    # The constant bound lets Spark cut every group before the shuffle.
    return ranked.filter(F.col("rank") <= most).filter(F.col("rank") <= left)


def queue(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows in order (a top-k, not a sort of everything)."""
    return df.orderBy(*order).limit(most)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
