"""Readers: raw payload parquet, headed CSV with aliases, JSON, rosters, dated files, JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def raw_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(query, raw_json)`` of a parquet file or folder; other columns are not read."""
    return spark.read.parquet(path).select("query", "raw_json")


def csv_text(spark: SparkSession, path: str | list[str], missing_ok: bool = False) -> DataFrame:
    """A headed CSV with every column as text; a byte order mark is dropped, quoted line breaks are kept."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"')
    if missing_ok:
        reader = reader.option("ignoreMissingFiles", True)
    df = reader.csv(path)
    return df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))


def aliased(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under canonical names: the first alias that the header has, without regard to case; null if it has none."""
    held = {}
    for c in df.columns:
        held.setdefault(c.strip().lower(), c)
    out = []
    for name, options in aliases.items():
        real = [held[o.lower()] for o in options if o.lower() in held]
        out.append((F.coalesce(*(F.col(f"`{r}`") for r in real)) if real else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


#: Header aliases of the roster files.
ROSTER = {
    "ceo": ["ceo"],
    "company": ["company"],
    "ceo_alias": ["ceo alias", "alias"],
    "company_alias": ["company alias"],
    "websites": ["website(s)", "websites", "website", "domain", "url", "site", "homepage"],
    "ticker": ["stock", "ticker"],
    "sector": ["sector", "industry"],
    "favorite": ["favorite"],
}


def roster(spark: SparkSession, path: str) -> DataFrame:
    """The roster under canonical names; rows without a company, or with ``nan`` for one, are left out; first row of a pair wins."""
    df = aliased(csv_text(spark, path), ROSTER)
    good = df.filter(F.trim("company").isNotNull() & (F.trim("company") != "") & (F.lower(F.trim("company")) != "nan"))
    return good.dropDuplicates(["company", "ceo"])


def json_document(spark: SparkSession, path: str) -> DataFrame:
    """A file that holds one JSON document."""
    return spark.read.option("multiLine", True).json(path)


def dates_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``date`` for every day from ``first`` to ``last``, both included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def dated_paths(folder: str, suffix: str, first: str, last: str) -> dict[str, str]:
    """Expected file of each day, ``<folder>/<date><suffix>``."""
    a, b = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    days = [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]
    return {d.isoformat(): f"{folder}/{d.isoformat()}{suffix}" for d in days}


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that exist in their file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            out.append(p)
    return out


def jdbc_table(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int, int] | None = None) -> DataFrame:
    """A database table; with ``column`` and ``bounds`` (low, high, parts) it is read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if column and bounds:
        reader = reader.options(partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=bounds[2])
    return reader.load()


def html_text(html: Column) -> Column:
    """Text of an HTML fragment: scripts, styles, comments and tags dropped, references resolved, blanks collapsed."""
    from tidemark.functions.text import squeeze, unescape_html

    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return squeeze(unescape_html(F.regexp_replace(bare, r"(?s)<[^>]*>", " ")))


def source_name(title: Column, link: Column) -> Column:
    """A feed item's source: its own title, else the host of its link."""
    from tidemark.functions.urls import host

    return F.coalesce(F.nullif(F.trim(title), F.lit("")), F.nullif(host(link), F.lit("")), F.lit(""))
