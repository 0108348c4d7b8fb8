"""Series packed as parallel pipe-separated lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable


def explode_history(df: DataFrame, keys: list[str], dates: str, values: str, value_name: str = "value") -> DataFrame:
    """One row ``(keys, date, value)`` a point; lists of unlike length give none, bad dates are dropped, bad values null."""
    d, v = F.split(dates, r"\|"), F.split(values, r"\|")
    zipped = F.when(F.size(d) == F.size(v), F.arrays_zip(d.alias("d"), v.alias("v")))
    rows = df.select(*keys, F.explode_outer(zipped).alias("p")).filter("p is not null")
    out = rows.select(*keys, F.trim("p.d").try_cast("date").alias("date"), F.trim("p.v").try_cast("double").alias(value_name))
    return out.filter("date is not null")


def pct_change(values: Column, back: int) -> Column:
    """Percent from the element ``back`` places before the last to the last; null if either is missing or the base is 0."""
    last, base = F.try_element_at(values, F.lit(-1)), F.try_element_at(values, F.lit(-1 - back))
    return F.when(base != 0, (last - base) / base * 100)


def snapshots(df: DataFrame, key: str, day: str, value: str, lags: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Per key and row the percent change against ``lags`` rows before (the first row where there are fewer)."""
    w = Window.partitionBy(key).orderBy(day)
    cols = []
    for lag in lags:
        base = F.coalesce(F.lag(value, lag).over(w), F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        cols.append(F.when(base != 0, (F.col(value) - base) / base * 100).alias(f"change_{lag}"))
    return df.select(key, day, value, *cols)


def batch_of(df: DataFrame, order: list[str], batches: int) -> DataFrame:
    """``df`` with ``batch`` (from 1): consecutive slices whose bounds are ``floor(b * n / batches)``.

    Ranks come from range partitions and their offsets, not from one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = durable(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    # One row a partition: the offsets are a running sum over the partitions.
    before = Window.orderBy("__part")
    offsets = sizes.select("__part", "__first", (F.sum("__n").over(before) - F.col("__n")).alias("__before"))
    total = sizes.agg(F.sum("__n").alias("__total"))
    placed = held.join(F.broadcast(offsets), "__part").crossJoin(F.broadcast(total))
    rank = F.col("__before") + F.col("__at") - F.col("__first")
    batch = F.floor(((rank + 1) * batches - 1) / F.col("__total")).cast("int") + 1
    return placed.withColumn("batch", batch).select(*df.columns, "batch")
