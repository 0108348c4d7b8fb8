"""Operators beside the extended queries: partial uniqueness, ordered tags, percentiles by counts, types, contradictions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.casts import looks_like_date, sanitized
from tidemark.operators.merge import partial_upsert
from tidemark.operators.rollups import exact_percentile
from tidemark.plans.extended import canonical_types, day_or_since, optional_filter, ordered_tags, pattern_score, stored_types
from tidemark.plans.maintain import resolve_entity


def test_partial_upsert(spark):
    cols = "id long, kind string, k string, v string"
    old = spark.createDataFrame([(1, "u", "a", "old"), (2, "u", "b", "old"), (3, "x", "a", "old"), (4, None, "a", "old")], cols)
    new = spark.createDataFrame([(9, "u", "a", "n9"), (8, "u", "a", "n8"), (7, "x", "a", "n7"), (6, "u", None, "n6")], cols)
    got = {(r.id, r.v) for r in partial_upsert(old, new, ["k"], F.col("kind") == "u", "id").collect()}
    assert got == {(9, "n9"), (2, "old"), (6, "n6"), (3, "old"), (7, "n7"), (4, "old")}


def test_exact_percentile(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([None, *range(12)])) for k in "abc" for _ in range(rng.randrange(1, 60))] + [("d", 5), ("e", None)] + [("hot", 3)] * 500
    got = {r.k: (r.n, r.p) for r in exact_percentile(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", 0.97).collect()}
    for key in {k for k, _ in rows} - {"e"}:
        values = [v for k, v in rows if k == key and v is not None]
        assert got[key][0] == len(values) and got[key][1] == pytest.approx(np.percentile(values, 97))
    assert "e" not in got


def test_ordered_tags(spark):
    rows = [("e", "b", "crisis"), ("e", "a", "other"), ("e", "c", "other"), ("e", "c", "other"), ("e", None, None), (None, "z", None)]
    got = {r.e: r.tags for r in ordered_tags(spark.createDataFrame(rows, "e string, tag string, g string"), ["e"], "tag", F.col("g"), "crisis").collect()}
    assert got == {"e": "c:2|b:1|a:1", None: "z:1"}


def test_types_and_filters(spark):
    df = spark.createDataFrame([(1, [" Brand", "ceo", "company", "odd", None], "a", "2025-01-02"), (2, None, "b", "2025-01-01")], "i int, t array<string>, k string, d string")
    got = {r.i: r.c for r in df.select("i", canonical_types(F.col("t")).alias("c")).collect()}
    assert got == {1: ["company", "ceo"], 2: None}
    assert stored_types("ceo") == ["ceo", "ceos"] and len(stored_types("all")) == 5
    assert [r.i for r in optional_filter(df, {"k": "b", "i": None}).collect()] == [2]
    day = F.col("d").cast("date")
    assert [df.filter(day_or_since(day, "2025-01-01", one)).count() for one in (True, False)] == [1, 2]
    assert [r[0] for r in df.select(pattern_score(F.col("k"), {"a": 2, "[ab]": 3})).collect()] == [5, 3]


def test_an_entity_told_twice(spark):
    df = spark.createDataFrame([("1", "Alpha"), ("2", "Beta")], "id string, name string")
    assert resolve_entity(df, "id", "name", "1", "ALPHA").count() == 1 and resolve_entity(df, "id", "name", entity_name="beta").first().id == "2"
    with pytest.raises(ValueError, match="different"):
        resolve_entity(df, "id", "name", "1", "Beta")
    with pytest.raises(ValueError, match="no entity"):
        resolve_entity(df, "id", "name", "3", "Beta")


def test_dates_and_blanks(spark):
    texts = ["3 days ago", "1 hour", "5h", "2025-03-04 10:00", "March 5, 2025", "Sept 9 2024", "5 daylight", "in the mayor 5", "", None, "nothing 12"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(looks_like_date(F.col("t"))).collect()] == [True] * 6 + [False] * 3 + [None, False]
    odd = spark.createDataFrame([(float("nan"),), (None,), (1.5,)], "x double")
    assert [r[0] for r in odd.select(sanitized(F.col("x"))).collect()] == ["", "", "1.5"]
