"""Queries of the general training-data operators (problems 1, 2, 3 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.drift import schema_changes, unified
from tidemark.operators.moments import offset_histories, place, read_moments, resolve, zone_evidence
from tidemark.operators.packed import ADDRESS_DELIMITERS, unpack
from tidemark.operators.rolling import trailing
from tidemark.session import durable, small, table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every value of every packed cell with its place."""
    sites = unpack(table(spark, sf, "companies"), "id", "websites", ADDRESS_DELIMITERS)
    heads = unpack(table(spark, sf, "negative_articles_summary"), "summary_id", "top_headlines")
    return sites.unionByName(heads)


def p2_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """Totals and daily averages over 7 and 30 days for every entity and calendar day."""
    rolled = trailing(
        table(spark, sf, "ceo_articles_daily_counts_chart"), ["edition", "ceo"], "date", ["negative", "total"], (7, 30), order="load_id"
    )
    return rolled.select(
        "edition",
        "ceo",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        *(f"{v}_{w}" for v in ("negative", "total") for w in (7, 30)),
        *((F.col(f"{v}_{w}") / w).alias(f"{v}_avg_{w}") for v in ("negative", "total") for w in (7, 30)),
    )


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which an entity's coverage turned: see TESTDATA.md. Compared on integers."""
    rolled = p2_rolling(spark, sf)
    return rolled.filter(
        (F.col("negative_7") >= 8)
        & (2 * F.col("negative_7") > F.col("total_7"))
        & (30 * F.col("negative_7") > 14 * F.col("negative_30"))
    ).select("edition", "ceo", "day")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each change of schema from file to file."""
    return schema_changes(table(spark, sf, "raw_file_records"))


#: The unified tables' columns by feed.
CHART_COLUMNS = {
    "date": "date",
    "ceo": "string",
    "company": "string",
    "positive": "bigint",
    "neutral": "bigint",
    "negative": "bigint",
    "total": "bigint",
    "neg_pct": "double",
    "theme": "string",
    "alias": "string",
}
MODAL_COLUMNS = {
    "ceo": "string",
    "company": "string",
    "title": "string",
    "url": "string",
    "source": "string",
    "published_at": "string",
    "sentiment": "string",
    "controlled": "string",
    "finance_routine": "boolean",
    "uncertain": "boolean",
    "llm_label": "string",
    "llm_severity": "string",
    "llm_reason": "string",
}


def p3_chart_table(spark: SparkSession, sf: str) -> DataFrame:
    """All lines of the daily chart feed in one schema."""
    raw = table(spark, sf, "raw_file_records").filter("feed = 'ceo-articles-daily-counts-chart'")
    return unified(raw, CHART_COLUMNS)


def p3_modal_table(spark: SparkSession, sf: str) -> DataFrame:
    """All lines of the modal feed in one schema."""
    raw = table(spark, sf, "raw_file_records").filter("feed = 'ceo-articles-modal'")
    return unified(raw, MODAL_COLUMNS)


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    """``(table_name, row_id, source, m, seen)`` of both tables."""
    clocks = small(table(spark, sf, "news_sources").select("source", "day_first"))
    modal = table(spark, sf, "ceo_articles_modal").select(
        F.lit("ceo_articles_modal").alias("table_name"),
        "row_id",
        "source",
        F.col("published_at").alias("text"),
        F.lit(None).cast("timestamp").alias("run_at"),
        (F.to_timestamp("file_date") + F.expr("interval 1 day")).alias("seen"),
    )
    serp = table(spark, sf, "serp_feature_items").select(
        F.lit("serp_feature_items").alias("table_name"),
        F.col("item_id").alias("row_id"),
        "source",
        F.col("published_date").alias("text"),
        F.col("run_at").cast("timestamp").alias("run_at"),
        F.col("run_at").cast("timestamp").alias("seen"),
    )
    rows = modal.unionByName(serp).join(clocks, "source", "left")
    read = read_moments(rows, "text", "run_at", "day_first")
    # The evidence and the conversion both need the readings; the texts are taken apart once.
    # No filter on ``m`` before the cut: the optimizer would push it, and with it the whole reading, below the projections.
    return durable(read.select("table_name", "row_id", "source", "m", "seen"))


#: Zones of the list of sources; each is a candidate for every source.
MAX_ZONES = 1000


def _clocks(spark: SparkSession, sf: str, readings: DataFrame) -> DataFrame:
    declared = table(spark, sf, "news_sources").select("source", "tz")
    zones = [r.tz for r in declared.filter("tz is not null").select("tz").distinct().limit(MAX_ZONES + 1).collect()]
    if len(zones) > MAX_ZONES:
        raise ValueError(f"more than {MAX_ZONES} zones are listed")
    # A few rows a source; kept, as the check of their size and the join both read them.
    return durable(offset_histories(zone_evidence(readings, sorted({*zones, "UTC"})), declared))


def p5_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: the zones in use over time, as estimated from the data, with the declared one."""
    return _clocks(spark, sf, _readings(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every value that names a moment, in milliseconds since 1970, by the estimated clock of its source."""
    readings = _readings(spark, sf)
    placed = place(readings, _clocks(spark, sf, readings), table(spark, sf, "news_sources").select("source", "tz"))
    return placed.select("table_name", "row_id", resolve(F.col("m"), F.col("zone")).alias("epoch_ms")).filter("epoch_ms is not null")


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_rolling": p2_rolling,
    "p3_found": p3_found,
    "p3_chart_table": p3_chart_table,
    "p3_modal_table": p3_modal_table,
    "p5_found": p5_found,
    "p5_zones": p5_zones,
}

_P2 = """
WITH best AS (
  SELECT edition, ceo, date,
         arg_max(coalesce(negative, 0), load_id) AS negative, arg_max(coalesce(total, 0), load_id) AS total
  FROM ceo_articles_daily_counts_chart GROUP BY ALL
), reach AS (SELECT edition, ceo, min(date) AS lo, max(date) AS hi FROM best GROUP BY ALL),
spine AS (SELECT edition, ceo, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date FROM reach),
filled AS (
  SELECT s.edition, s.ceo, s.date, coalesce(b.negative, 0) AS n, coalesce(b.total, 0) AS t
  FROM spine s LEFT JOIN best b ON b.edition = s.edition AND b.ceo = s.ceo AND b.date = s.date
), rolled AS (
  SELECT edition, ceo, strftime(date, '%Y-%m-%d') AS day,
    CAST(sum(n) OVER w7 AS BIGINT) AS negative_7, CAST(sum(n) OVER w30 AS BIGINT) AS negative_30,
    CAST(sum(t) OVER w7 AS BIGINT) AS total_7, CAST(sum(t) OVER w30 AS BIGINT) AS total_30
  FROM filled
  WINDOW w7 AS (PARTITION BY edition, ceo ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY edition, ceo ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
)
"""
ORACLES = {
    "p2_rolling": _P2
    + """SELECT *, negative_7 / 7.0::DOUBLE AS negative_avg_7, negative_30 / 30.0::DOUBLE AS negative_avg_30,
            total_7 / 7.0::DOUBLE AS total_avg_7, total_30 / 30.0::DOUBLE AS total_avg_30 FROM rolled""",
    "p2_found": _P2
    + """SELECT edition, ceo, day FROM rolled
         WHERE negative_7 >= 8 AND 2 * negative_7 > total_7 AND 30 * negative_7 > 14 * negative_30""",
}
