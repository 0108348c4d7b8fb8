"""Percentiles of very large numeric columns by cumulative frequencies.

Rows become counts per group and value before anything is sorted; counts of
days, files or partitions add up, so results from separate parts combine
exactly. The counts are range-sorted by group and value, each range keeps a
running sum, and the totals of the ranges before it in the same group are added
as an offset: a group of any size is spread over as many tasks as its values
need. A percentile is read where the running count first reaches its rank. The
error is zero: the stated bound is exactness up to double arithmetic in the
interpolation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``(groups, value, n)``: how often each non-null value occurs in each group. Nulls and NaN do not count."""
    rows = df.select(*groups, F.col(value).cast("double").alias("value")).filter("value is not null and not isnan(value)")
    return rows.groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*parts: DataFrame) -> DataFrame:
    """The counts of several parts as one; the order and cut of the parts do not matter."""
    whole = reduce(DataFrame.unionByName, parts)
    groups = [c for c in whole.columns if c not in ("value", "n")]
    return whole.groupBy(*groups, "value").agg(F.sum("n").alias("n"))


def percentiles(counts: DataFrame, groups: list[str], points: dict[str, float]) -> DataFrame:
    """``(groups, n, <names of points>)``: linearly interpolated percentiles of every group of ``counts``.

    ``points`` maps result columns to shares in [0, 1]. The percentile of n values
    at share p lies at rank p * (n - 1), between its two neighbours in order.
    Groups without a value give no row; null groups are groups of their own; ties
    and repeated rows count as often as they occur. ``n`` is the number of values.
    """
    keys = [f"g{i}" for i in range(len(groups))]
    plain = counts.select(*(F.col(c).alias(k) for c, k in zip(groups, keys, strict=True)), "value", "n")
    # The ranges are cut by sampling; the checkpoint makes the cut the same for both readers below.
    ranged = durable(plain.repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy(*keys, "part").agg(F.sum("n").alias("held"))
    over_parts = Window.partitionBy(*keys).orderBy("part")
    offsets = sums.select(
        *(F.col(k).alias(f"o_{k}") for k in keys),
        F.col("part").alias("o_part"),
        (F.sum("held").over(over_parts) - F.col("held")).alias("before"),
        F.sum("held").over(Window.partitionBy(*keys)).alias("total"),
    )
    same = [F.col("part") == F.col("o_part")] + [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys]
    running = Window.partitionBy("part", *keys).orderBy("value")
    placed = (
        ranged.withColumn("upto", F.sum("n").over(running))
        .join(offsets, same)
        .select(*keys, "value", "total", (F.col("before") + F.col("upto")).alias("last"), (F.col("before") + F.col("upto") - F.col("n")).alias("first"))
    )
    picks = []
    for name, share in points.items():
        rank = F.lit(share) * (F.col("total") - 1)
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            hit = (F.col("first") <= at) & (at < F.col("last"))
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"{name}_{side}"))
    read = placed.groupBy(*keys).agg(F.max("total").alias("total"), *picks)

    def between(name: str, share: float):
        rank = F.lit(share) * (F.col("total") - 1)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (lo + (hi - lo) * (rank - F.floor(rank))).alias(name)

    return read.select(
        *(F.col(k).alias(c) for c, k in zip(groups, keys, strict=True)),
        F.col("total").alias("n"),
        *(between(name, share) for name, share in points.items()),
    )
