"""Mixing sources to target weights, measured in tokens.

The plan gives every source its target share of the total size, at most its
``max_repeats`` uses; what short sources leave open is given to the others in
proportion to their targets, so that these keep their weights among themselves.
A document's number of copies comes from a Poisson distribution, inverted at a
uniform number hashed from the document's id and a seed: the same document gets
the same copies in any run and any partitioning. The distribution's mean, the
target repetition rate, is solved on a sketch of the source's own hash numbers
weighted with tokens, so that the source reaches its planned tokens and not only
their expectation. Documents are exploded by their counts and shuffled globally.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable, small

if TYPE_CHECKING:  # loaded in the workers only
    import numpy as np
    import pandas as pd
    import pyarrow as pa

#: Fixed value: how a byte-level vocabulary of this kind cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Buckets of the sketch of a source's hash numbers.
BUCKETS = 4096


def _counter(ranks_file: bytes, text_at: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]
            cols = {c: batch.column(c) for c in keep}
            yield pa.RecordBatch.from_pydict(cols | {"tokens": pa.array(counts, pa.int64())})

    return run


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``tokens`` (bigint): the tokens of every whole text; a null or empty text has 0.

    ``vocabulary`` is the driver's path of a file of ranks; its content travels to the executors.
    """
    keep = keep if keep is not None else [c for c in df.columns if c not in (text, "tokens")]
    picked = df.select(*keep, F.col(text).cast("string").alias("__text"))
    kinds = dict(picked.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["tokens bigint"])
    with open(vocabulary, "rb") as lines:
        return picked.mapInArrow(_counter(lines.read(), "__text", keep), schema)


def source_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, max_repeats, tokens, wanted, planned, rate)`` for each source of ``targets``.

    ``sizes`` has ``(source, tokens)``, one row a source. ``wanted`` is the target
    share of all tokens. ``planned`` is what the source will give: at most
    ``tokens * max_repeats``, and else its target times one level for all sources,
    the least at which the plan has as many tokens as there are in all (if all
    sources together cannot give that, each gives what it can). ``rate`` is
    ``planned`` over ``tokens``, 0 for a source without tokens. Sources without a
    target count in the total and are not used; of a source listed twice one row
    counts; a null target or null repeats count as 0. The list of targets is
    small: its rows are ordered in one task.
    """
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens"))
    listed = targets.filter("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t"))
    known = (
        listed.select("source", F.coalesce("t.target_share", F.lit(0.0)).alias("target_share"), F.coalesce("t.max_repeats", F.lit(0)).alias("max_repeats"))
        .join(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens")), "source", "left")
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("bigint")))
        .withColumn("full", F.col("tokens") * F.col("max_repeats"))
        .withColumn("wanted", F.col("target_share") * F.col("all_tokens"))
    )
    # Sources in the order in which a rising level exhausts them: the level is right once the next one is not exhausted.
    order = Window.orderBy(F.try_divide("full", "target_share").asc_nulls_last(), "source")
    before = F.coalesce(F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("target_share").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = known.withColumn("level", F.try_divide(F.col("all_tokens") - before, after)).withColumn("no", F.row_number().over(order))
    right = levels.filter(F.col("level") <= F.try_divide("full", "target_share")).agg(F.min_by("level", "no").alias("level"))
    planned = F.when(F.col("level").isNull(), F.col("full")).otherwise(F.least(F.col("level") * F.col("target_share"), F.col("full")))
    return known.crossJoin(F.broadcast(right)).select(
        "source",
        "target_share",
        "max_repeats",
        "tokens",
        "wanted",
        planned.cast("double").alias("planned"),
        F.coalesce(F.try_divide(planned, F.col("tokens")), F.lit(0.0)).alias("rate"),
    )


def poisson_steps(lam: float, cap: int) -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... copies up to ``cap - 1``; in logarithms, so that no mean is too large."""
    import numpy as np

    if lam <= 0:
        return np.ones(min(cap, 1))
    # beyond this number of copies nothing is left of the distribution
    top = min(cap, int(lam + 12 * math.sqrt(lam) + 40))
    logs = np.log(np.arange(1, top))
    return np.minimum(1.0, np.cumsum(np.exp(np.r_[0.0, np.cumsum(math.log(lam) - logs)] - lam))) if top else np.zeros(0)


def solve_mean(u: np.ndarray, weight: np.ndarray, planned: float, cap: int) -> float:
    """The Poisson mean at which numbers ``u`` of ``weight`` give ``planned`` in all, copies being cut at ``cap``."""
    import numpy as np

    def given(lam: float) -> float:
        return float((weight * np.minimum(np.searchsorted(poisson_steps(lam, cap), u, side="right"), cap)).sum())

    if planned <= 0 or cap <= 0:
        return 0.0
    lo, hi = 0.0, max(1.0, planned / max(1.0, float(weight.sum())))
    while given(hi) < planned and hi < 1e9:
        lo, hi = hi, 2 * hi
    while hi - lo > 1e-12 * hi:
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if given(mid) < planned else (lo, mid)
    return lo if planned - given(lo) < given(hi) - planned else hi


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) hashed from the key and the seed."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    import pandas as pd

    first = pdf.iloc[0]
    cap, full = int(first["max_repeats"]), float(first["tokens"]) * int(first["max_repeats"])
    saturated = float(first["planned"]) >= full
    steps = [] if saturated else poisson_steps(solve_mean((pdf["bucket"].to_numpy() + 0.5) / BUCKETS, pdf["weight"].to_numpy(), float(first["planned"]), cap), cap).tolist()
    return pd.DataFrame({"source": [first["source"]], "cap": [cap], "saturated": [saturated], "steps": [steps]})


def copy_counts(docs: DataFrame, sized: DataFrame, plan: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """``docs`` with ``copies``, how often each document is used; documents whose source is not planned are left out.

    ``sized`` has ``source``, ``key`` and ``tokens`` of the same documents. A source that
    is planned to its full extent uses each document ``max_repeats`` times. A
    column ``copies`` of ``docs`` is replaced.
    """
    bucket = F.floor(uniform(F.col(key), seed) * BUCKETS).cast("int")
    # At most BUCKETS rows a source, however many documents it has.
    sketch = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("tokens").cast("double").alias("weight"))
    steps = (
        plan.select("source", "max_repeats", "tokens", "planned")
        .join(sketch, "source")
        .groupBy("source")
        .applyInPandas(_solve, "source string, cap int, saturated boolean, steps array<double>")
    )
    steps = small(durable(steps.select(F.col("source").alias("__source"), "cap", "saturated", "steps")))
    u = uniform(F.col(key), seed)
    drawn = F.least(F.size(F.filter("steps", lambda s: s <= u)), F.col("cap"))
    kept = [c for c in docs.columns if c != "copies"]
    joined = docs.join(steps, F.col("source") == F.col("__source"))
    return joined.select(*(docs[c] for c in kept), F.when(F.col("saturated"), F.col("cap")).otherwise(drawn).alias("copies"))


def replicate(docs: DataFrame, sized: DataFrame, plan: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """``docs`` with one row for each copy and the copy's number ``copy_no`` (from 0), globally shuffled.

    The copies of a document are at most its source's ``max_repeats``; documents
    whose source is null or has no target are left out. A column ``copy_no`` or
    ``copies`` of ``docs`` is replaced. See ``copy_counts``.
    """
    out = copy_counts(docs.drop("copy_no"), sized, plan, key, seed).filter("copies > 0")
    out = out.withColumn("copy_no", F.explode_outer(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    # A hashed order key spreads every source over all ranges; sorting by it is the global shuffle.
    order = F.xxhash64(F.col(key).cast("string"), F.col("copy_no"), F.lit(seed + 1))
    return out.withColumn("mix_order", order).repartitionByRange("mix_order").sortWithinPartitions("mix_order", key, "copy_no")


def reached(sized: DataFrame, plan: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """``(source, target_share, planned_share, reached_share, deviation, tokens, mixed_tokens, short)`` of the replicated documents.

    ``sized`` has ``source``, ``key`` and ``tokens``. ``deviation`` is the share reached
    less the target. ``short`` is read off the copies: every document of the source
    is used as often as allowed, and its copies hold less than the target share of
    all tokens. A source without documents is short of any target.
    """
    counts = copy_counts(sized.select("source", key, F.col("tokens").alias("size")), sized, plan, key, seed)
    got = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("mixed_tokens"), F.min("copies").alias("least"))
    total = got.agg(F.sum("mixed_tokens").alias("all_mixed"))
    hoped = plan.agg(F.sum("planned").alias("all_planned"))
    out = plan.join(small(got), "source", "left").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(hoped))  # one row each
    mine = F.coalesce("mixed_tokens", F.lit(0).cast("bigint"))
    share = F.coalesce(F.try_divide(mine, F.col("all_mixed")), F.lit(0.0))
    return out.select(
        "source",
        "target_share",
        F.coalesce(F.try_divide("planned", "all_planned"), F.lit(0.0)).alias("planned_share"),
        share.alias("reached_share"),
        (share - F.col("target_share")).alias("deviation"),
        "tokens",
        mine.alias("mixed_tokens"),
        (F.coalesce(F.col("least") >= F.col("max_repeats"), F.lit(True)) & (mine < F.col("wanted"))).alias("short"),
    )
