"""Keyed merges of a source into a target, without a transactional store.

Policies per column: ``new`` (the source's value), ``fill`` (the source's value
unless null), ``keep`` (the target's), ``least`` and ``greatest``. The result is a whole new
table; write it to a staging folder and swap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: list[str], order: Column | str, last: bool = True) -> DataFrame:
    """One row a key: that with the greatest (or least) ``order``; ties are settled by the row's other values."""
    rest = [c for c in df.columns if c not in keys]
    order = F.col(order) if isinstance(order, str) else order
    pick = F.max if last else F.min
    # A hash of the row settles ties without asking that every column be sortable.
    best = df.withColumn("__o", order).withColumn("__h", F.xxhash64(*rest) if rest else F.lit(0))
    if not rest:
        return df.distinct()
    return best.groupBy(*keys).agg(pick(F.struct("__o", "__h", *rest)).alias("__r")).select(*[F.col(k) for k in keys], *(F.col(f"__r.{c}").alias(c) for c in rest)).select(*df.columns)


def merge(target: DataFrame, source: DataFrame, keys: list[str], policy: dict[str, str] | None = None, default: str = "new") -> DataFrame:
    """``target`` with ``source`` merged in by ``keys`` (null-safe); both must be unique by key.

    Columns that only one side has are null on the other side's new rows.
    """
    policy = policy or {}
    columns = list(dict.fromkeys([*target.columns, *source.columns]))
    t = target.select(F.struct(*target.columns).alias("t"), *(F.col(k).alias(f"tk_{k}") for k in keys))
    s = source.select(F.struct(*source.columns).alias("s"), *(F.col(k).alias(f"sk_{k}") for k in keys))
    on = [F.col(f"tk_{k}").eqNullSafe(F.col(f"sk_{k}")) for k in keys]
    joined = t.join(s, on, "full_outer")
    out = []
    for c in columns:
        old = F.col(f"t.{c}") if c in target.columns else F.lit(None)
        new = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        rule = policy.get(c, default)
        if c in keys:
            value = F.when(F.col("s").isNotNull(), new).otherwise(old)
        elif rule == "fill":
            value = F.coalesce(new, old)
        elif rule == "keep":
            value = F.when(F.col("t").isNotNull(), old).otherwise(new)
        elif rule in ("least", "greatest"):
            value = getattr(F, rule)(old, new)
        else:
            value = F.when(F.col("s").isNotNull(), new).otherwise(old) if c in source.columns else old
        out.append(value.alias(c))
    return joined.select(*out)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and those rows of ``source`` whose key it lacks."""
    fresh = source.join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def partial_upsert(target: DataFrame, source: DataFrame, keys: list[str], where: Column, order: str) -> DataFrame:
    """Both tables, of which rows that hold ``where`` are unique by ``keys``: the source's before the target's, the greatest ``order`` first.

    Rows for which ``where`` does not hold are all kept.
    """
    both = target.withColumn("__new", F.lit(0)).unionByName(source.withColumn("__new", F.lit(1)))
    held = F.coalesce(where, F.lit(False))
    one = dedupe(both.filter(held), keys, F.struct("__new", order))
    return one.unionByName(both.filter(~held)).drop("__new")


def replace_window(target: DataFrame, source: DataFrame, day: str, start: str, end: str, within: Column | None = None) -> DataFrame:
    """``target`` without the days ``[start, end)`` (where ``within`` holds), and ``source``."""
    gone = (F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date"))
    if within is not None:
        gone = gone & within
    return target.filter(~F.coalesce(gone, F.lit(False))).unionByName(source)


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` taken from ``source`` where the key is there; no rows are added."""
    s = source.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("__hit"))
    joined = target.join(s, keys, "left")
    values = {c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*(values[c].alias(c) if c in values else F.col(c) for c in target.columns))


def delete_matching(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the keys of ``source``."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti")


def surrogate(*natural: Column) -> Column:
    """An id that follows from the natural key, so that no lookup is needed after a write."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in natural)), 256)


def retain_months(df: DataFrame, day: str, months: int, as_of: Column) -> DataFrame:
    """Rows from the first day of the month ``months`` before ``as_of`` on."""
    return df.filter(F.col(day) >= F.trunc(F.add_months(as_of, -months), "month"))


def rekey(df: DataFrame, column: str, moves: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``df`` with ``column`` renamed by ``moves (old, new)``; of rows that then share ``keys``, the target's own row stays.

    Among moved rows with one key the first by ``order`` (or by value) stays.
    """
    moved = df.join(moves, df[column] == moves["old"], "left")
    at = F.when(F.col("old").isNotNull(), 1).otherwise(0)
    renamed = moved.withColumn("__rank", at).withColumn(column, F.coalesce("new", F.col(column))).drop("old", "new")
    first = F.struct("__rank", *(order or []))
    return dedupe(renamed, keys, first, last=False).drop("__rank")
