"""Mixing: token counts, Poisson steps in logarithms, levels of the plan, shares, repeatability."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.catalog import VOCABULARY
from tidemark.llm.mixing import PATTERN, copy_counts, count_tokens, poisson_steps, reached, replicate, solve_mean, source_plan


def test_tokens(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Two people said so.", "", "<|endoftext|>", "größer — 12,5 %", None, "y" * 50_001]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("tokens", F.lit("clash"))
    got = {r.doc_id: r.tokens for r in count_tokens(df, VOCABULARY, keep=["doc_id"]).collect()}
    assert got == {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}


@pytest.mark.parametrize("lam", [0.0, 0.3, 2.5, 40.0, 900.0, 5000.0])
def test_steps_are_the_distribution(lam):
    steps = poisson_steps(lam, 10_000)
    mean = (1 - steps).sum()
    assert math.isclose(mean, lam, rel_tol=1e-9, abs_tol=1e-12) and (np.diff(steps) >= 0).all()


@pytest.mark.parametrize("rate,cap", [(0.3, 1), (0.9, 2), (2.5, 3), (1.0, 6), (0.0, 2), (800.0, 2000), (1990.0, 2000)])
def test_means_give_the_rate(rate, cap):
    u, weight = (np.arange(20_000) + 0.5) / 20_000, np.full(20_000, 7.0)
    copies = np.minimum(np.searchsorted(poisson_steps(solve_mean(u, weight, rate * weight.sum(), cap), cap), u, side="right"), cap)
    assert abs(copies.mean() - rate) < 1e-3 * max(1.0, rate)


def test_shares_and_caps(spark):
    rows = [(i, "big" if i < 6000 else "small" if i < 6300 else "tiny", 10 + i % 7) for i in range(6400)] + [(9001, None, 10), (9002, "off", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, tokens long").withColumns({"copy_no": F.lit(-1), "copies": F.lit(5), "rate": F.lit(2)})
    targets = spark.createDataFrame(
        [("big", 0.5, 2), ("small", 0.1, 5), ("tiny", 0.3, 3), ("gone", 0.1, 2), (None, 0.2, 1)], "source string, target_share double, max_repeats int"
    )
    plan = source_plan(docs.groupBy("source").agg(F.sum("tokens").alias("tokens")), targets)
    p = {r.source: r for r in plan.collect()}
    total = sum(r[2] for r in rows)
    # what tiny and gone leave open is shared out by target
    assert p["tiny"].planned == 3 * p["tiny"].tokens and p["gone"].planned == 0
    assert math.isclose(p["big"].planned, 5 * p["small"].planned, rel_tol=1e-9)
    assert math.isclose(sum(r.planned for r in p.values()), total, rel_tol=1e-9)
    out = replicate(docs, docs, plan, "doc_id")
    copies = Counter((r.source, r.doc_id) for r in out.collect())
    for s, cap in (("big", 2), ("small", 5), ("tiny", 3)):
        assert max(n for (src, _), n in copies.items() if src == s) <= cap
    assert all(n == 3 for (src, _), n in copies.items() if src == "tiny") and sum(src == "tiny" for src, _ in copies) == 100
    assert not any(src in (None, "off") for src, _ in copies)
    assert copies == Counter((r.source, r.doc_id) for r in replicate(docs.repartition(7), docs, plan, "doc_id").collect())
    shares = {r.source: r for r in reached(docs, plan, "doc_id").collect()}
    assert all(abs(r.reached_share - r.planned_share) < 2e-3 for r in shares.values())
    assert abs(sum(r.reached_share for r in shares.values()) - 1) < 1e-9
    assert {s for s, r in shares.items() if r.short} == {"tiny", "gone"}


def test_what_is_short_is_read_off_the_copies(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], 10) for i in range(2000)], "doc_id long, source string, tokens long")
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    plan = source_plan(sizes, spark.createDataFrame([("a", 0.8, 1), ("b", 0.2, 1)], "source string, target_share double, max_repeats int"))
    assert [r.source for r in reached(docs, plan, "doc_id").filter("short").collect()] == ["a"]
    # the same plan with the rate of a halved by hand: its documents are not used up, so nothing is short
    halved = plan.withColumn("planned", F.when(F.col("source") == "a", 5000.0).otherwise(F.col("planned")))
    assert reached(docs, halved, "doc_id").filter("short").count() == 0
    assert abs(copy_counts(docs, docs, halved, "doc_id").filter("source = 'a'").agg(F.sum("copies")).first()[0] - 500) <= 2


def test_reachable_sources_keep_their_weights(spark):
    rows = [(i, f"s{i % 10}", 5 + i % 11) for i in range(20_000)] + [(50_000, "few", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([*[(f"s{i}", 0.05 + 0.005 * i, 9) for i in range(10)], ("few", 0.275, 3)], "source string, target_share double, max_repeats int")
    plan = source_plan(docs.groupBy("source").agg(F.sum("tokens").alias("tokens")), targets)
    got = {r.source: r for r in reached(docs, plan, "doc_id").collect()}
    level = [r.reached_share / r.target_share for s, r in got.items() if s != "few"]
    assert max(level) / min(level) < 1.01 and got["few"].short and got["few"].deviation < -0.27


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 1.0, 2), ("b", None, None)], "source string, target_share double, max_repeats int")
    plan = source_plan(docs.groupBy("source").agg(F.sum("tokens").alias("tokens")), targets)
    assert [r.rate for r in plan.collect()] == [0.0, 0.0]
    assert replicate(docs, docs, plan, "doc_id").count() == 0
    assert reached(docs, plan, "doc_id").filter("short").count() == 0
