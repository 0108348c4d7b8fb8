"""Daily counts, rosters, percentile baselines and other aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SENTIMENTS = ("positive", "neutral", "negative")


def effective_label(*labels: Column) -> Column:
    """The first label that is there: override, enriched, base."""
    return F.coalesce(*labels)


def sentiment_pivot(df: DataFrame, keys: list[str], label: str, controlled: Column | None = None) -> DataFrame:
    """Counts of all rows, of controlled ones and of each sentiment, by keys."""
    aggs = [F.count(F.lit(1)).alias("total")]
    if controlled is not None:
        aggs.append(F.count_if(controlled).alias("controlled"))
    return df.groupBy(*keys).agg(*aggs, *(F.count_if(F.col(label) == s).alias(s) for s in SENTIMENTS))


def brand_daily(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Counts by sentiment where anything unknown is neutral; ``neg_pct`` is a fraction."""
    s = F.when(F.col(label).isin("positive", "negative"), F.col(label)).otherwise("neutral")
    out = sentiment_pivot(df.withColumn("__s", s), keys, "__s")
    return out.withColumn("neg_pct", F.try_divide("negative", "total"))


def roster_daily(df: DataFrame, keys: list[str], label: str, roster: DataFrame) -> DataFrame:
    """Counts by sentiment for every key of the roster, 0 where nothing is; unknown sentiments are left out of the total.

    ``neg_pct`` is in percent with one decimal, ties to even.
    """
    counts = df.filter(F.col(label).isin(*SENTIMENTS)).groupBy(*keys).agg(*(F.count_if(F.col(label) == s).alias(s) for s in SENTIMENTS))
    full = roster.select(*keys).distinct().join(counts, keys, "left").fillna(0, list(SENTIMENTS))
    total = F.col("positive") + F.col("neutral") + F.col("negative")
    pct = F.coalesce(F.bround(F.try_divide(100 * F.col("negative"), total), 1), F.lit(0.0))
    return full.withColumn("total", total).withColumn("neg_pct", pct)


def modal(value: Column) -> Column:
    """Most frequent non-blank value; the least on a tie."""
    return F.mode(F.nullif(value, F.lit("")), deterministic=True)


def exact_percentile(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """``(keys, n, p)``: each key's number of values and exact percentile with linear interpolation; nulls do not count.

    Rows become counts by key and value before the shuffle, so a key holds as many
    rows as it has different values; these are sorted, not gathered in memory.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    run = Window.partitionBy(*keys).orderBy("__v")
    ranked = counts.withColumn("__upto", F.sum("__c").over(run)).withColumn("n", F.sum("__c").over(Window.partitionBy(*keys)))
    at = F.lit(share) * (F.col("n") - 1)
    low, high = (F.min(F.when(F.col("__upto") > f(at), F.col("__v"))) for f in (F.floor, F.ceil))
    got = ranked.groupBy(*keys, "n").agg(low.alias("__low"), high.alias("__high"))
    part = at - F.floor(at)
    return got.select(*keys, "n", ((1 - part) * F.col("__low") + part * F.col("__high")).alias("p"))


def risk_scores(df: DataFrame, keys: list[str], count: str, gate: str, min_history: int = 14, floor: float = 15.0, share: float = 0.97, weight: int = 2) -> DataFrame:
    """``df`` with ``baseline_p97`` and ``risk_score``.

    The baseline is the key's exact percentile of ``count`` with linear
    interpolation, or ``floor`` where the history is shorter than ``min_history``.
    """
    base = exact_percentile(df, keys, count, share)
    base = base.select(*(F.col(k).alias(f"__{k}") for k in keys), F.when(F.col("n") >= min_history, F.col("p")).otherwise(floor).alias("__base"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = df.join(base, on, "left").withColumn("baseline_p97", F.coalesce("__base", F.lit(floor))).drop("__base")
    score = F.greatest(F.col(count) - F.col("baseline_p97"), F.lit(0.0)) + weight * F.col(gate)
    return joined.drop(*(f"__{k}" for k in keys)).withColumn("risk_score", score)


def top_texts(df: DataFrame, keys: list[str], text: Column, order: list[str], most: int = 3, sep: str = "|") -> DataFrame:
    """The first ``most`` texts of each key in ``order``, joined.

    Ranks are cut per partition before the shuffle by keeping the least ones only.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    # Spark keeps only the first ranks of each key before the shuffle (a window group limit).
    first = df.withColumn("__t", text).withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("__rn", "__t")))
    return first.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["__t"]), sep).alias("top_headlines"))


def unpivot_counts(df: DataFrame, keys: list[str], columns: list[str], name: str = "feature_type", value: str = "total_count") -> DataFrame:
    """Wide counts as one row each, those above 0."""
    return df.unpivot(keys, columns, name, value).filter(F.col(value) > 0)


def recompute_daily(items: DataFrame, keys: list[str], label: Column) -> DataFrame:
    """Daily counts from items, with the least entity id of each key."""
    rows = items.withColumn("__l", label)
    return rows.groupBy(*keys).agg(
        F.min("entity_id").alias("entity_id"),
        F.count(F.lit(1)).alias("total_count"),
        *(F.count_if(F.col("__l") == s).alias(f"{s}_count") for s in SENTIMENTS),
    )


def previous_day(df: DataFrame, keys: list[str], day: str, columns: list[str]) -> DataFrame:
    """``df`` with ``prev_<column>`` of the calendar day before; a missing day counts 0."""
    before = df.select(*keys, F.date_add(day, 1).alias(day), *(F.col(c).alias(f"prev_{c}") for c in columns))
    return df.join(before, [*keys, day], "left").fillna(0, [f"prev_{c}" for c in columns])


def tag_counts(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """Map of tag to count by keys."""
    n = df.groupBy(*keys, tag).agg(F.count(F.lit(1)).cast("int").alias("__n"))
    return n.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(tag, "__n")))).alias("tag_counts"))
