"""Percentiles against numpy; parts, ties, nulls, one group with most rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.quantiles import merge_counts, percentiles, value_counts

POINTS = {"p50": 0.5, "p97": 0.97, "p0": 0.0, "p100": 1.0}


def test_against_numpy(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([None, float("nan"), 1.5, 1.5, float(rng.randrange(50)), -3.0])) for _ in range(3000)]
    rows.append(("one", 7.0))
    rows.append(("none", None))
    df = spark.createDataFrame(rows, "grp string, x double").withColumns({"n": F.lit(1), "value": F.lit(9.0), "part": F.lit(2)})
    whole = value_counts(df, ["grp"], "x")
    halves = merge_counts(value_counts(df.filter("rand(1) < 0.5"), ["grp"], "x"), value_counts(df.filter("rand(1) >= 0.5"), ["grp"], "x"))
    for counts in (whole, halves):
        got = {r.grp: r for r in percentiles(counts, ["grp"], POINTS).collect()}
        assert set(got) == {"hot", "a", "b", None, "one"}
        for g, r in got.items():
            xs = [x for k, x in rows if k == g and x is not None and x == x]
            assert r.n == len(xs)
            for name, share in POINTS.items():
                assert np.isclose(r[name], np.quantile(xs, share)), (g, name)


def test_empty(spark):
    df = spark.createDataFrame([], "grp string, x double")
    assert percentiles(value_counts(df, ["grp"], "x"), ["grp"], POINTS).count() == 0
