"""Resolution of names against a roster by joins; every rule for ties is explicit.

A roster is a bounded reference list. It is sent to the executors when a check
of its size allows; where a rule is no equality (containment, token subsets),
the join is keyed by a token so that no pairs are made that share nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import small


def unique_lookup(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` of keys that have exactly one value; blank keys are dropped."""
    good = pairs.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return good.groupBy(key).agg(F.countDistinct(value).alias("n"), F.min(value).alias(value)).filter("n = 1").drop("n")


def fallback_chain(df: DataFrame, name: str, roster: DataFrame, roster_name: str, value: str, keys: list[tuple[str, object]]) -> DataFrame:
    """``df`` with ``value`` and ``match_type``: the first of several keys, each unambiguous in the roster, that hits.

    ``keys`` are ``(label, function of a name column)``.
    """
    out = df
    for i, (_, fn) in enumerate(keys):
        pairs = roster.select(fn(F.col(roster_name)).alias(f"__k{i}"), F.col(value).alias(f"__v{i}"))
        look = unique_lookup(pairs, f"__k{i}", f"__v{i}")
        out = out.withColumn(f"__k{i}", fn(F.col(name))).join(small(look), f"__k{i}", "left")
    label = F.lit(None).cast("string")
    for i in reversed(range(len(keys))):
        label = F.when(F.col(f"__v{i}").isNotNull(), keys[i][0]).otherwise(label)
    picked = F.coalesce(*(F.col(f"__v{i}") for i in range(len(keys))))
    return out.select(*df.columns, picked.alias(value), label.alias("match_type"))


def _ranked(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__rn = 1").drop("__rn")


def contains_longest(df: DataFrame, text: str, roster: DataFrame, name: str, value: str) -> DataFrame:
    """``(text, value)``: the entry with the longest ``name`` that stands in ``text`` as whole words.

    Both are keys of space-separated words. The join runs on the first word of
    the name. Ties go to the least value.
    """
    texts = df.select(text).filter(F.col(text) != "").distinct()
    tokens = texts.select(text, F.explode(F.array_distinct(F.split(text, " "))).alias("__t"))
    names = roster.filter(F.col(name) != "").select(F.col(name).alias("__n"), F.col(value).alias("__v"), F.split(name, " ")[0].alias("__t"))
    hit = F.concat(F.lit(" "), F.col(text), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("__n"), F.lit(" ")))
    found = tokens.join(small(names), "__t").filter(hit)
    best = _ranked(found, [text], [F.length("__n").desc(), F.col("__v")])
    return best.select(text, F.col("__v").alias(value))


def suffix_longest(df: DataFrame, text: str, roster: DataFrame, name: str, value: str) -> DataFrame:
    """``(text, value, rest)``: the entry whose name is the longest ending of ``text``, and what stands before it."""
    texts = df.select(text).filter(F.col(text) != "").distinct()
    tokens = texts.select(text, F.element_at(F.split(text, " "), -1).alias("__t"))
    names = roster.filter(F.col(name) != "").select(F.col(name).alias("__n"), F.col(value).alias("__v"), F.element_at(F.split(name, " "), -1).alias("__t"))
    found = tokens.join(small(names), "__t").filter(F.endswith(text, F.col("__n")))
    best = _ranked(found, [text], [F.length("__n").desc(), F.col("__v")])
    return best.select(text, F.col("__v").alias(value), F.trim(F.left(text, F.length(text) - F.length("__n"))).alias("rest"))


def token_subset(df: DataFrame, text: str, roster: DataFrame, name: str, value: str) -> DataFrame:
    """``(text, value, score)``: the entry with the most words all of which stand in ``text``; ties to the least value.

    Joined on the least frequent word of each entry (by roster), so a text meets
    only entries that it can hold.
    """
    texts = df.select(text).filter(F.col(text) != "").distinct().withColumn("__w", F.array_distinct(F.split(text, " ")))
    tokens = texts.select(text, "__w", F.explode("__w").alias("__t"))
    names = roster.filter(F.col(name) != "").select(F.array_distinct(F.split(name, " ")).alias("__nw"), F.col(value).alias("__v"))
    flat = names.select("__nw", "__v", F.explode("__nw").alias("__t"))
    rare = flat.join(flat.groupBy("__t").agg(F.count(F.lit(1)).alias("__df")), "__t")
    keyed = _ranked(rare, ["__v", "__nw"], [F.col("__df"), F.col("__t")]).select("__t", "__nw", "__v")
    found = tokens.join(small(keyed), "__t").filter(F.size(F.array_except("__nw", "__w")) == 0)
    best = _ranked(found, [text], [F.size("__nw").desc(), F.col("__v")])
    return best.select(text, F.col("__v").alias(value), F.size("__nw").alias("score"))


def tiers(df: DataFrame, name: str, roster: DataFrame, roster_name: str, value: str, key: object) -> DataFrame:
    """``(name, value, tier)``: exact, then case-insensitive, then normalised, then partial (either contains the other).

    Partial matches need three characters on both sides; the shorter name's words
    key the join. Within a tier the least value wins.
    """
    names = df.select(name).filter(F.col(name).isNotNull() & (F.col(name) != "") & (F.col(name) != "nan")).distinct()
    ref = roster.select(F.col(roster_name).alias("__n"), F.col(value).alias("__v")).filter("__n is not null")
    exact = names.join(small(ref), F.col(name) == F.col("__n")).withColumn("__tier", F.lit(0))
    lower = names.join(small(ref), F.lower(name) == F.lower("__n")).withColumn("__tier", F.lit(1))
    norm = names.withColumn("__k", F.lower(key(F.col(name)))).join(small(ref.withColumn("__rk", F.lower(key(F.col("__n"))))), F.col("__k") == F.col("__rk")).filter("__k != ''").drop("__k", "__rk").withColumn("__tier", F.lit(2))
    a, b = F.lower(name), F.lower("__n")
    grams = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3)))
    left = names.filter(F.length(name) >= 3).select(name, F.explode(F.array_distinct(grams(F.lower(name)))).alias("__g"))
    start = ref.filter("length(__n) >= 3").select("__n", "__v", F.substring(F.lower("__n"), 1, 3).alias("__g"))
    holds = left.join(small(start), "__g").filter(F.contains(a, b)).drop("__g")
    every = ref.filter("length(__n) >= 3").select("__n", "__v", F.explode(F.array_distinct(grams(F.lower("__n")))).alias("__g"))
    first = names.filter(F.length(name) >= 3).withColumn("__g", F.substring(F.lower(name), 1, 3))
    held = first.join(small(every), "__g").filter(F.contains(b, a)).drop("__g")
    cols = [name, "__v", "__tier"]
    partial = holds.unionByName(held).withColumn("__tier", F.lit(3))
    whole = exact.select(*cols).unionByName(lower.select(*cols)).unionByName(norm.select(*cols)).unionByName(partial.select(*cols))
    best = _ranked(whole, [name], [F.col("__tier"), F.col("__v")])
    labels = F.array(*map(F.lit, ("exact", "case-insensitive", "normalized", "partial")))
    return best.select(name, F.col("__v").alias(value), F.get(labels, F.col("__tier")).alias("tier"))


def fuzzy_score(a: Column, b: Column) -> Column:
    """0 to 100: how well the words of key ``b`` cover those of key ``a``; extra words and another first word cost."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    overlap = F.size(F.array_intersect(x, y))
    base = F.floor(100 * (0.65 * overlap / F.greatest(F.size(x), F.lit(1)) + 0.35 * overlap / F.greatest(F.size(y), F.lit(1))) + 1e-9)
    extra = F.greatest(F.size(y) - F.size(x), F.lit(0)) * 8
    head = F.when(F.startswith(b, F.concat(a, F.lit(" "))) | F.startswith(a, F.concat(b, F.lit(" "))), 5).otherwise(0)
    other = F.when(F.split(a, " ")[0] != F.split(b, " ")[0], 10).otherwise(0)
    score = F.greatest(base - extra + head - other, F.lit(0)).cast("int")
    return F.when((a == "") | (b == ""), 0).when(a == b, 100).when(overlap == 0, 0).otherwise(score)


def best_account(df: DataFrame, key: str, accounts: DataFrame, account_key: str, value: str, least: int = 78, lead: int = 4) -> DataFrame:
    """``(key, value, score)`` of the account that scores at least ``least`` and leads the next by ``lead``."""
    names = df.select(key).filter(F.col(key) != "").distinct()
    left = names.select(key, F.explode(F.array_distinct(F.split(key, " "))).alias("__t"))
    right = accounts.filter(F.col(account_key) != "").select(F.col(account_key).alias("__k"), F.col(value).alias("__v"), F.explode(F.array_distinct(F.split(account_key, " "))).alias("__t"))
    pairs = left.join(small(right), "__t").select(key, "__k", "__v").distinct().withColumn("score", fuzzy_score(F.col(key), F.col("__k")))
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), "__v")
    ranked = pairs.withColumn("__rn", F.row_number().over(w)).withColumn("__next", F.lead("score").over(w))
    ok = (F.col("__rn") == 1) & (F.col("score") >= least) & (F.col("score") - F.coalesce("__next", F.lit(0)) >= lead)
    return ranked.filter(ok).select(key, F.col("__v").alias(value), "score")


def close_names(df: DataFrame, name: str, roster: DataFrame, roster_name: str, cutoff: float = 0.6) -> DataFrame:
    """``(name, match, ratio)``: the roster name most like ``name`` by the ratio of matching blocks, at least ``cutoff``.

    The ratio needs a matcher that Spark lacks; it runs in Arrow batches over
    distinct names, each held against the broadcast roster.
    """
    import difflib

    import pandas as pd

    ref = [r[0] for r in roster.select(roster_name).filter(F.col(roster_name).isNotNull()).distinct().orderBy(roster_name).limit(100_001).collect()]
    if len(ref) > 100_000:
        raise ValueError("the roster is too long to be held against every name")
    held = df.sparkSession.sparkContext.broadcast(ref)

    def run(batches):
        for pdf in batches:
            out = []
            for x in pdf[name]:
                top = difflib.get_close_matches(x, held.value, n=1, cutoff=cutoff)
                if top:
                    out.append((x, top[0], difflib.SequenceMatcher(None, top[0], x).ratio()))
            yield pd.DataFrame(out, columns=[name, "match", "ratio"])

    return df.select(name).filter(F.col(name).isNotNull()).distinct().mapInPandas(run, f"{name} string, match string, ratio double")
