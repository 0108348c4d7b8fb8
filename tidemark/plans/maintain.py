"""Entity merges and verification over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(target: Column, source: Column) -> Column:
    """The target's non-blank value, else the source's."""
    return F.coalesce(F.nullif(target, F.lit("")), F.nullif(source, F.lit("")))


def overlap(df: DataFrame, entity: str, source: Column, target: Column, keys: list[str]) -> DataFrame:
    """One row ``(source_rows, target_rows, shared)``: what a merge of ``source`` into ``target`` would meet. Keys compare null-safe."""
    a = df.filter(F.col(entity) == source).select(*keys)
    b = df.filter(F.col(entity) == target).select(*(F.col(k).alias(f"b_{k}") for k in keys)).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys]
    shared = a.join(b, on, "left_semi").agg(F.count(F.lit(1)).alias("shared"))
    both = df.agg(F.count_if(F.col(entity) == source).alias("source_rows"), F.count_if(F.col(entity) == target).alias("target_rows"))
    return both.crossJoin(F.broadcast(shared))


def coverage(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(table_name, n, first, last)`` of each table's rows and days."""
    out = None
    for name, (df, day) in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n"), F.min(day).cast("date").alias("first"), F.max(day).cast("date").alias("last")).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def resolve_entity(df: DataFrame, key: str, name: str, entity_id: str | None = None, entity_name: str | None = None) -> DataFrame:
    """The entity with an id, a name (any case) or both; an error if there is none, another if id and name tell different ones."""
    by_id = F.col(key) == entity_id if entity_id is not None else F.lit(True)
    by_name = F.lower(name) == entity_name.lower() if entity_name is not None else F.lit(True)
    seen = df.agg(F.count_if(by_id & by_name).alias("both"), F.count_if(by_id).alias("ids"), F.count_if(by_name).alias("names")).first()
    if seen.both == 0:
        if seen.ids and seen.names:
            raise ValueError("the id and the name given tell different entities")
        raise ValueError("no entity fits the id and name given")
    return df.filter(by_id & by_name)


def require(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row of named counts; an error naming the first that is below its bound. ``checks`` are boolean aggregates."""
    row = df.agg(*(c.alias(n) for n, c in checks.items())).first()
    for n in checks:
        if not row[n]:
            raise ValueError(f"guard failed: {n}")
    return df
