"""Feature items of search-result documents: one scan, exploded once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import json_length, looks_like_date, to_rank
from tidemark.functions.names import clean_text

#: Item families: path below the payload, title fields, link fields.
FAMILIES = {
    "organic": ("organic_results", ("title",), ("link",)),
    "aio_citations": ("ai_overview.references", ("title",), ("link",)),
    "paa_items": ("related_questions", ("question", "title"), ("link",)),
    "videos_items": ("inline_videos", ("title",), ("link", "url")),
    "short_videos_items": ("short_videos", ("title",), ("link", "url")),
    "perspectives_items": ("perspectives", ("title",), ("link",)),
    "top_stories_items": ("top_stories", ("title",), ("link",)),
}
DATE_FIELDS = ("date", "published_date", "published_at", "published", "time_ago", "upload_date")


def _items(doc: Column, path: str) -> Column:
    """Elements of an array in a document, as text; anything else than an array gives none."""
    at = F.coalesce(F.get_json_object(doc, f"$.data.{path}"), F.get_json_object(doc, f"$.{path}"))
    return F.when(at.startswith("["), F.from_json(at, "array<string>"))


def first_text(item: Column, fields: tuple[str, ...]) -> Column:
    """First non-blank of several fields of a JSON object."""
    return F.coalesce(*(F.nullif(clean_text(F.get_json_object(item, f"$.{f}")), F.lit("")) for f in fields))


def date_text(item: Column) -> Column:
    """What an item says of its date: the first date field, else the first date-like extension."""
    own = first_text(item, DATE_FIELDS)
    found = []
    for path in ("$.detected_extensions", "$.extensions", "$.rich_snippet.top.detected_extensions", "$.rich_snippet.top.extensions"):
        raw = F.get_json_object(item, path)
        listed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
        keys = F.when(raw.startswith("{"), F.json_object_keys(raw))
        values = F.filter(F.transform(F.coalesce(listed, keys), clean_text), looks_like_date)
        found.append(F.get(values, 0))
    return F.coalesce(own, *found)


def explode_items(df: DataFrame, keys: list[str], doc: str = "raw_json", families: dict | None = None) -> DataFrame:
    """One row an item: ``keys, feature, ordinal`` (from 1), ``title, url, snippet, source, position, date_text``.

    Elements that are no objects are skipped but keep their ordinal; unreadable documents give none.
    """
    families = families or FAMILIES
    packs = F.array(*(F.struct(F.lit(name).alias("feature"), _items(F.col(doc), path).alias("items")) for name, (path, _, _) in families.items()))
    flat = df.select(*keys, F.explode(packs).alias("p")).select(*keys, "p.feature", F.posexplode_outer("p.items").alias("ordinal", "item"))
    flat = flat.filter(F.col("item").startswith("{"))
    title, link = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (_, t, u) in families.items():
        title = F.when(F.col("feature") == name, first_text(F.col("item"), t)).otherwise(title)
        link = F.when(F.col("feature") == name, first_text(F.col("item"), u)).otherwise(link)
    item = F.col("item")
    return flat.select(
        *keys,
        "feature",
        (F.col("ordinal") + 1).alias("ordinal"),
        F.coalesce(title, F.lit("")).alias("title"),
        F.coalesce(link, F.lit("")).alias("url"),
        F.coalesce(first_text(item, ("snippet", "answer")), F.lit("")).alias("snippet"),
        F.coalesce(first_text(item, ("source",)), F.lit("")).alias("source"),
        F.coalesce(to_rank(F.get_json_object(item, "$.position")), to_rank(F.get_json_object(item, "$.rank"))).alias("position"),
        F.coalesce(date_text(item), F.lit("")).alias("date_text"),
    )


def counts(df: DataFrame, keys: list[str], doc: str = "raw_json") -> DataFrame:
    """Per document the length of each family's array, 0 where it is missing or no array."""
    return df.select(*keys, *(json_length(F.col(doc), f"$.data.{path}").alias(name) for name, (path, _, _) in FAMILIES.items()))


def query_metrics(df: DataFrame, query: str = "query", doc: str = "raw_json") -> DataFrame:
    """One row: distinct queries, those with a payload, with valid JSON and with organic results."""
    q = F.nullif(F.trim(query), F.lit(""))
    valid = F.get_json_object(doc, "$").isNotNull()
    organic = json_length(F.col(doc), "$.data.organic_results") > 0
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(q).alias("queries"),
        F.count_distinct(F.when(F.col(doc).isNotNull(), q)).alias("with_payload"),
        F.count_distinct(F.when(valid, q)).alias("with_json"),
        F.count_distinct(F.when(organic, q)).alias("with_organic"),
    )
