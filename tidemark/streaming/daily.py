"""Structured Streaming: daily counts, idempotent claims, event state per entity."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pandas as pd


def daily_counts(stream: DataFrame, ts: str, keys: list[str], label: str, late: str = "1 day") -> DataFrame:
    """Counts by entity and calendar day; rows later than ``late`` behind the newest are dropped."""
    return (
        stream.withWatermark(ts, late)
        .groupBy(F.window(ts, "1 day").alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(label) == "negative").alias("negative"))
        .select(F.to_date("w.start").alias("date"), *keys, "total", "negative")
    )


def claims(stream: DataFrame, ts: str, key: str, late: str = "1 day") -> DataFrame:
    """The first row of each key; repeats within the watermark are dropped."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def carried_state(stream: DataFrame, key: str) -> DataFrame:
    """``(key, date, active)`` from daily rows ``(key, date, base, carry)`` that arrive in order of date.

    A day is active if ``base``, or if the calendar day before was active and
    ``carry``; the state of a key is its last day and whether it was active.
    """

    def step(k: tuple, rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        import pandas as pd

        last, active = state.get if state.exists else (None, False)
        out = []
        for r in pd.concat(list(rows)).sort_values("date").itertuples():
            day = pd.Timestamp(r.date)
            linked = last is not None and (day - pd.Timestamp(last)).days == 1
            active = bool(r.base) or (bool(active) and linked and bool(r.carry))
            last = day.date().isoformat()
            out.append((k[0], day.date(), active))
        state.update((last, active))
        yield pd.DataFrame(out, columns=[key, "date", "active"])

    kind = dict(stream.dtypes)[key]
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, date date, active boolean", "last string, active boolean", "append", "NoTimeout")
