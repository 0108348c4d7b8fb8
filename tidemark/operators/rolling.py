"""Totals over trailing periods for every entity and calendar day.

The window is a two-stack queue over a monoid. The front stack holds running
aggregates from the window's start to the last flip, the back stack the running
aggregate since the flip; a window's value is front combined with back. With a
window of W days the flips fall every W days, so both stacks are prefix and
suffix scans of blocks of W days: three vector operations for a whole sorted
partition, one combine a day, and no inverse of the operation is needed
(``maximum`` works as ``add`` does).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:  # loaded in the workers only
    import numpy as np
    import pyarrow as pa

#: Monoids: numpy's name of the operation, its identity among 64-bit integers and among doubles (null: integers only),
#: and Spark's aggregate for rows of one day.
MONOIDS = {
    "sum": ("add", 0, 0.0, F.sum),
    "max": ("maximum", -(2**63), float("-inf"), F.max),
    "min": ("minimum", 2**63 - 1, float("inf"), F.min),
    # sets of up to 64 members as bits: their union has no inverse
    "union": ("bitwise_or", 0, None, F.bit_or),
}
#: Days in a block of an entity's calendar; a longer history is split over tasks.
BLOCK_DAYS = 366


def two_stacks(values: np.ndarray, window: int, op: np.ufunc, identity: float) -> np.ndarray:
    """``op`` over each trailing ``window`` of ``values``; short at the start."""
    import numpy as np

    n = len(values)
    if n == 0:
        return values.copy()
    pad = -n % window
    blocks = np.concatenate([values, np.full(pad, identity, values.dtype)]).reshape(-1, window)
    back = op.accumulate(blocks, axis=1).reshape(-1)[:n]
    front = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    at = np.arange(n) - window + 1
    kept = np.where(at >= 0, front[np.maximum(at, 0)], identity)
    return np.where(at % window == 0, back, op(kept, back))


def _roll(windows: tuple[int, ...], op_name: str, identities: list[float], n_keys: int):
    n_values = len(identities)
    halo = max(windows) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            last = held["grp"][held.num_rows - 1]
            groups = held["grp"].to_numpy()
            done = int(np.searchsorted(groups == last.as_py(), True)) if groups[0] != last.as_py() else 0
            if done == 0:
                continue
            yield from emit(held.slice(0, done))
            held = held.slice(done)
        if held is not None and held.num_rows:
            yield from emit(held)

    def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        op = getattr(np, op_name)
        groups = t["grp"].to_numpy()
        day = t["day"].to_numpy()
        start = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        lo, hi = t["lo"].to_numpy()[start], t["hi"].to_numpy()[start]
        base = lo - halo
        length = hi - base + 1
        offset = np.r_[0, np.cumsum(length)]
        owner = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(groups)]))
        at = offset[owner] + day - base[owner]
        which = np.repeat(np.arange(len(start)), length)
        pos = np.arange(offset[-1]) - offset[which]
        keep = pos >= halo
        cols = [t.column(f"k{i}").take(pa.array(start[which[keep]])) for i in range(n_keys)]
        cols.append(pa.array((pos[keep] + base[which[keep]]).astype(np.int32)))
        for v in range(n_values):
            identity = identities[v]
            dense = np.full(offset[-1], identity, np.float64 if isinstance(identity, float) else np.int64)
            dense[at] = t[f"v{v}"].to_numpy()
            for w in windows:
                # every entity's axis begins with a halo of identities or of its own earlier days
                cols.append(pa.array(two_stacks(dense, w, op, identity)[keep]))
        names = [f"k{i}" for i in range(n_keys)] + ["day"]
        names += [f"v{v}_{w}" for v in range(n_values) for w in windows]
        yield from pa.table(dict(zip(names, cols, strict=True))).combine_chunks().to_batches()

    return run


def trailing(
    df: DataFrame,
    keys: list[str],
    day: str,
    values: list[str],
    windows: tuple[int, ...] = (7, 30),
    order: str | None = None,
    monoid: str = "sum",
) -> DataFrame:
    """Aggregates over trailing windows for each entity and day from its first to its last row.

    Result: the keys, ``day`` (date) and ``<value>_<w>`` for every value
    and window, a bigint for whole numbers and a double for others. A window ends with its day and includes it. Per entity and day
    only the row with the highest ``order`` counts (on a tie the largest values;
    without ``order`` all rows of a day are added up). Nulls and missing days
    count as the monoid's identity in the window (0 for sums). Rows with a null
    day are left out, null keys are an entity of their own, repeated rows do not
    change the result when ``order`` is given. Extra columns are ignored.

    The day's rows are reduced before any shuffle of the entity's rows. An entity
    is then split into blocks of ``BLOCK_DAYS`` calendar days, each with the days
    before it that its first windows reach back to, so that no task holds more
    of an entity than one block.
    """
    op_name, whole, broken, combine = MONOIDS[monoid]
    types = dict(df.dtypes)
    double = [types[c].startswith(("float", "double", "decimal", "string")) for c in values]
    if broken is None and any(double):
        raise ValueError(f"{monoid} takes whole numbers only")
    identities = [broken if d else whole for d in double]
    sql = ["double" if d else "bigint" for d in double]
    none = [F.lit(i).cast(t) for i, t in zip(identities, sql, strict=True)]
    k = [f"k{i}" for i in range(len(keys))]
    v = [f"v{i}" for i in range(len(values))]
    halo = max(windows) - 1
    rows = df.select(
        *(F.col(c).alias(a) for c, a in zip(keys, k, strict=True)),
        F.unix_date(F.col(day).cast("date")).alias("day"),
        *(F.col(c).cast(t).alias(a) for c, a, t in zip(values, v, sql, strict=True)),
        *([F.col(order).alias("ord")] if order else []),
    ).filter("day is not null")
    if order:
        best = rows.groupBy(*k, "day").agg(F.max(F.struct("ord", *v)).alias("top"))
        daily = best.select(*k, "day", *(F.coalesce(F.col(f"top.{c}"), i).alias(c) for c, i in zip(v, none, strict=True)))
    else:
        daily = rows.groupBy(*k, "day").agg(*(F.coalesce(combine(c), i).alias(c) for c, i in zip(v, none, strict=True)))
    # An entity's reach: after the reduction above it is one row a day at most, and map-side combined.
    reach = daily.groupBy(*k).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    reach = reach.select(*(F.col(c).alias(f"r_{c}") for c in k), "first", "last")
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in k]
    joined = daily.join(reach, same if len(same) > 1 else same[0])
    block = F.floor((F.col("day") - F.col("first")) / BLOCK_DAYS).cast("int")
    into = F.floor((F.col("day") + halo - F.col("first")) / BLOCK_DAYS).cast("int")
    final = F.floor((F.col("last") - F.col("first")) / BLOCK_DAYS).cast("int")
    spread = joined.withColumn("block", F.explode_outer(F.sequence(block, F.least(into, final)))).select(
        *k,
        "block",
        "day",
        *v,
        (F.col("first") + F.col("block") * BLOCK_DAYS).alias("lo"),
        F.least(F.col("last"), F.col("first") + (F.col("block") + 1) * BLOCK_DAYS - 1).alias("hi"),
        "first",
    )
    # A block without rows of its own still has days: every block is present through a seed row.
    seeds = (
        reach.select(
            *(F.col(f"r_{c}").alias(c) for c in k),
            F.explode_outer(F.sequence(F.lit(0), F.floor((F.col("last") - F.col("first")) / BLOCK_DAYS).cast("int"))).alias("block"),
            "first",
            "last",
        )
        .select(
            *k,
            "block",
            (F.col("first") + F.col("block") * BLOCK_DAYS).alias("day"),
            *(i.alias(c) for c, i in zip(v, none, strict=True)),
            (F.col("first") + F.col("block") * BLOCK_DAYS).alias("lo"),
            F.least(F.col("last"), F.col("first") + (F.col("block") + 1) * BLOCK_DAYS - 1).alias("hi"),
            "first",
        )
        .filter("block > 0")
    )
    whole = spread.unionByName(seeds)
    # ``grp`` tells neighbouring entities apart; equal neighbours would need equal keys and blocks.
    cells = (
        whole.repartition(*k, "block")
        .groupBy(*k, "block", "day", "lo", "hi")
        .agg(*(combine(c).alias(c) for c in v))
        .withColumn("grp", F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in k), "block"))
        .sortWithinPartitions("grp", *k, "block", "day")
    )
    kinds = dict(cells.dtypes)
    schema = ", ".join(
        [f"{c} {kinds[c]}" for c in k] + ["day int"] + [f"{c}_{w} {t}" for c, t in zip(v, sql, strict=True) for w in windows]
    )
    rolled = cells.mapInArrow(_roll(tuple(windows), op_name, identities, len(keys)), schema)
    return rolled.select(
        *(F.col(a).alias(c) for c, a in zip(keys, k, strict=True)),
        F.date_from_unix_date("day").alias("day"),
        *(F.col(f"{a}_{w}").alias(f"{c}_{w}") for c, a in zip(values, v, strict=True) for w in windows),
    )
