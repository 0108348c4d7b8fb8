"""Trailing windows against a plain loop; blocks, ties, nulls, and a monoid without an inverse."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import rolling
from tidemark.operators.rolling import trailing, two_stacks


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-9, 9), max_size=60), st.integers(1, 12))
def test_two_stacks(values, window):
    a = np.array(values, dtype=np.int64)
    for op_name, identity, _, _ in rolling.MONOIDS.values():
        op = getattr(np, op_name)
        got = two_stacks(a, window, op, identity)
        want = [op.reduce(a[max(0, i - window + 1) : i + 1]) for i in range(len(a))]
        assert got.tolist() == want


def reference(rows, windows):
    best = {}
    for k, day, a, load in rows:
        if day is not None and (k, day) not in best or day is not None and load > best[(k, day)][1]:
            best[(k, day)] = (a or 0, load)
    out = {}
    for key in {k for k, _ in best}:
        days = sorted(d for k, d in best if k == key)
        for i in range((days[-1] - days[0]).days + 1):
            d = days[0] + dt.timedelta(days=i)
            out[(key, d)] = tuple(sum(best.get((key, d - dt.timedelta(days=j)), (0,))[0] for j in range(w)) for w in windows)
    return out


@pytest.mark.parametrize("block", [366, 5])
def test_against_loop(spark, monkeypatch, block):
    monkeypatch.setattr(rolling, "BLOCK_DAYS", max(block, 5))
    rng = random.Random(3)
    start = dt.date(2024, 2, 20)
    rows = [(rng.choice(["a", "b", None, "lone"]), start + dt.timedelta(days=rng.randrange(40)), rng.choice([None, 0, 1, 5]), i) for i in range(120)]
    rows += [("x", None, 3, 999), ("lone2", start, None, 1000)]
    df = spark.createDataFrame(rows, "ent string, date date, n int, load int").selectExpr("*", "ent as k0", "n as v0", "1 as day", "2 as lo")
    got = {(r.ent, r.day): (r.n_3, r.n_4) for r in trailing(df, ["ent"], "date", ["n"], (3, 4), "load").collect()}
    assert got == reference(rows, (3, 4))


def test_maximum_repeats_and_empty(spark):
    d = dt.date(2025, 1, 1)
    rows = [("a", d, 4, 1), ("a", d, 4, 1), ("a", d + dt.timedelta(days=3), 2, 1)]
    df = spark.createDataFrame(rows, "ent string, date date, n int, load int")
    got = [r.n_3 for r in trailing(df, ["ent"], "date", ["n"], (3,), "load", monoid="max").orderBy("day").collect()]
    assert got[0] == 4 and got[2] == 4 and got[3] == 2
    assert trailing(df.limit(0), ["ent"], "date", ["n"]).count() == 0


def test_fractions_and_unions(spark):
    d = dt.date(2025, 1, 1)
    rows = [("a", d + dt.timedelta(days=i), x, 1 << i) for i, x in enumerate([0.5, 0.7, None, 1.25])]
    df = spark.createDataFrame(rows, "ent string, date date, x double, tags long")
    got = [r.x_7 for r in trailing(df, ["ent"], "date", ["x"], (7,)).orderBy("day").collect()]
    assert got == pytest.approx([0.5, 1.2, 1.2, 2.45])
    assert [r.x_2 for r in trailing(df, ["ent"], "date", ["x"], (2,), monoid="max").orderBy("day").collect()] == [0.5, 0.7, 0.7, 1.25]
    # a set of members has no inverse: a member leaves with the last day that has it
    assert [r.tags_2 for r in trailing(df, ["ent"], "date", ["tags"], (2,), monoid="union").orderBy("day").collect()] == [1, 3, 6, 12]
    with pytest.raises(ValueError):
        trailing(df, ["ent"], "date", ["x"], (2,), monoid="union")
