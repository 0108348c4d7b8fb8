"""More queries of the reference operators: overrides, dimensions, staging, entity merges, evidence, enrichment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import casts, names
from tidemark.operators import events, merge, resolve, rollups
from tidemark.plans.reference import LEGAL_TAILS
from tidemark.session import small, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query and, if there is one, its SQL."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "serp_feature_items")


def _modal(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "ceo_articles_modal")


def _negative() -> Column:
    return F.col("sentiment_label") == "negative"


# --- filters, casts, arrays --------------------------------------------------


@query("flt_any_array", "SELECT item_id FROM serp_feature_items WHERE entity_id = ANY(SELECT id FROM companies WHERE favorite)")
def _any_array(spark, sf):
    wanted = table(spark, sf, "companies").filter("favorite").select(F.col("id").alias("entity_id"))
    return _items(spark, sf).join(small(wanted), "entity_id", "left_semi").select("item_id")


@query("flt_like_suffix", "SELECT summary_id FROM negative_articles_summary WHERE company || '|' || CAST(date AS VARCHAR) LIKE '%|2025-06-03'")
def _like_suffix(spark, sf):
    key = F.concat_ws("|", "company", F.col("date").cast("string"))
    return table(spark, sf, "negative_articles_summary").filter(key.endswith("|2025-06-03")).select("summary_id")


def day_or_since(day: Column, at: str, single: bool) -> Column:
    """Rows of one day, or of that day and all later ones."""
    return day == F.lit(at).cast("date") if single else day >= F.lit(at).cast("date")


@query("flt_dynamic_cond", """SELECT item_id, 'day' AS kind FROM serp_feature_items WHERE (true AND date = DATE '2025-05-05') OR (NOT true AND date >= DATE '2025-05-05')
UNION ALL SELECT item_id, 'since' FROM serp_feature_items WHERE (false AND date = DATE '2025-05-05') OR (NOT false AND date >= DATE '2025-05-05')""")
def _dynamic(spark, sf):
    t = _items(spark, sf)
    return t.filter(day_or_since(F.col("date"), "2025-05-05", True)).select("item_id", F.lit("day").alias("kind")).unionByName(
        t.filter(day_or_since(F.col("date"), "2025-05-05", False)).select("item_id", F.lit("since").alias("kind"))
    )


def optional_filter(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """``df`` where each column has the value given for it; a null value asks for nothing."""
    for column, value in wanted.items():
        df = df if value is None else df.filter(F.col(column) == value)
    return df


@query("flt_optional_entity", "SELECT item_id FROM serp_feature_items WHERE entity_type = 'ceo' AND feature_type = 'top_stories_items'")
def _optional(spark, sf):
    return optional_filter(_items(spark, sf), {"entity_type": "ceo", "entity_id": None, "feature_type": "top_stories_items"}).select("item_id")


@query("cast_sanitize", """SELECT load_id, CASE WHEN neutral IS NULL THEN '' ELSE CAST(neutral AS VARCHAR) END AS neutral,
CASE WHEN theme IS NULL OR lower(theme) = 'nan' THEN '' ELSE theme END AS theme FROM ceo_articles_daily_counts_chart""")
def _sanitize(spark, sf):
    t = table(spark, sf, "ceo_articles_daily_counts_chart")
    return t.select("load_id", *(casts.sanitized(F.col(c)).alias(c) for c in ("neutral", "theme")))


@query("arr_ordered_dedupe", """SELECT id, array_to_string(list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_position(w, w[i]) = i THEN w[i] END), lambda x: x IS NOT NULL), ' ') AS words
FROM (SELECT id, string_split(lower(title), ' ') AS w FROM articles)""")
def _ordered_dedupe(spark, sf):
    return table(spark, sf, "articles").select("id", F.array_join(F.array_distinct(F.split(F.lower("title"), " ")), " ").alias("words"))


@query("arr_concat", "SELECT item_id, array_to_string(list_concat(coalesce(narrative_tags, []), [feature_type, entity_type]), '|') AS tags FROM serp_feature_items")
def _concat(spark, sf):
    tags = F.coalesce("narrative_tags", F.array().cast("array<string>"))
    return _items(spark, sf).select("item_id", F.array_join(F.concat(tags, F.array("feature_type", "entity_type")), "|").alias("tags"))


@query("json_write", "SELECT id, CAST(to_json({'name': name, 'favorite': favorite}) AS VARCHAR) AS doc FROM companies")
def _json_write(spark, sf):
    return table(spark, sf, "companies").select("id", F.to_json(F.struct("name", "favorite")).alias("doc"))


@query("dec_coerce", "SELECT summary_id, CAST(CAST(risk_score AS DECIMAL(12, 2)) AS VARCHAR) AS score FROM negative_articles_summary")
def _decimal(spark, sf):
    return table(spark, sf, "negative_articles_summary").select("summary_id", F.col("risk_score").cast("decimal(12,2)").cast("string").alias("score"))


@query("date_coerce", "SELECT item_id, CAST(run_at AS DATE) AS day FROM serp_feature_items")
def _date(spark, sf):
    return _items(spark, sf).select("item_id", F.to_date("run_at").alias("day"))


#: Names under which entity types are stored.
TYPES = {"brand": "company", "brands": "company", "company": "company", "ceo": "ceo", "ceos": "ceo"}


def canonical_types(types: Column) -> Column:
    """Entity types under their canonical names, each once, in the order given; unknown ones are left out."""
    table_ = F.create_map(*(F.lit(x) for pair in TYPES.items() for x in pair))
    return F.array_distinct(F.filter(F.transform(types, lambda t: F.try_element_at(table_, F.lower(F.trim(t)))), lambda t: t.isNotNull()))


@query("types_normalize", """SELECT entity_name, array_to_string(list(DISTINCT t ORDER BY t), ',') AS types FROM (
SELECT entity_name, CASE WHEN lower(entity_type) IN ('brand', 'brands', 'company') THEN 'company' WHEN lower(entity_type) IN ('ceo', 'ceos') THEN 'ceo' END AS t FROM serp_feature_items) WHERE t IS NOT NULL GROUP BY 1""")
def _types(spark, sf):
    seen = _items(spark, sf).groupBy("entity_name").agg(F.array_sort(F.collect_set("entity_type")).alias("types"))
    return seen.select("entity_name", F.array_join(F.array_sort(canonical_types(F.col("types"))), ",").alias("types")).filter("types != ''")


def stored_types(which: str) -> list[str]:
    """The stored names of ``all``, ``brand`` or ``ceo``."""
    return sorted(t for t, c in TYPES.items() if which == "all" or c == TYPES[which])


@query("types_expand", "SELECT item_id FROM serp_feature_items WHERE entity_type IN ('brand', 'brands', 'company')")
def _expand(spark, sf):
    return _items(spark, sf).filter(F.col("entity_type").isin(stored_types("brand"))).select("item_id")


# --- joins -------------------------------------------------------------------

_OVER = "(SELECT company, url, max(llm_label) AS override FROM ceo_articles_modal WHERE llm_label IS NOT NULL GROUP BY 1, 2)"


def _overridden(spark, sf):
    """Article rows with the override of their company and link, if there is one."""
    m = _modal(spark, sf)
    over = m.filter("llm_label is not null").groupBy("company", "url").agg(F.max("llm_label").alias("override"))
    return m.join(over, ["company", "url"], "left").withColumn("label", rollups.effective_label(F.col("override"), F.col("sentiment")))


@query("join_left_override", f"SELECT m.row_id, coalesce(o.override, m.sentiment) AS label FROM ceo_articles_modal m LEFT JOIN {_OVER} o ON o.company = m.company AND o.url = m.url")
def _override(spark, sf):
    return _overridden(spark, sf).select("row_id", "label")


@query("join_or_cond", "SELECT i.item_id, k.id FROM serp_feature_items i JOIN companies k ON i.entity_id = k.id OR (i.entity_id IS NULL AND i.entity_name = k.name)")
def _or_cond(spark, sf):
    # Two equal joins instead of one on a disjunction; the second takes only rows that the first cannot have.
    i = _items(spark, sf).select("item_id", "entity_id", "entity_name")
    k = small(table(spark, sf, "companies").select("id", "name"))
    by_id = i.join(k, F.col("entity_id") == F.col("id")).select("item_id", "id")
    return by_id.unionByName(i.filter("entity_id is null").join(k, F.col("entity_name") == F.col("name")).select("item_id", "id"))


@query("join_lateral_unnest", """SELECT item_id, CAST(p - 1 AS INTEGER) AS pos, t[p] AS tag FROM (
SELECT item_id, narrative_tags AS t, unnest(range(1, len(narrative_tags) + 1)) AS p FROM serp_feature_items WHERE narrative_tags IS NOT NULL)""")
def _unnest(spark, sf):
    return _items(spark, sf).select("item_id", F.posexplode("narrative_tags").alias("pos", "tag"))


# --- aggregates --------------------------------------------------------------


@query("agg_article_metrics", f"""SELECT m.file_date AS date, m.company, count(*) FILTER (WHERE lower(coalesce(o.override, m.sentiment)) = 'negative') AS neg, count(*) AS total,
CAST(CAST(round(count(*) FILTER (WHERE lower(coalesce(o.override, m.sentiment)) = 'negative') / count(*), 4) AS DECIMAL(6, 4)) AS VARCHAR) AS pct
FROM ceo_articles_modal m LEFT JOIN {_OVER} o ON o.company = m.company AND o.url = m.url WHERE NOT m.finance_routine GROUP BY 1, 2""")
def _metrics(spark, sf):
    t = _overridden(spark, sf).filter("not finance_routine")
    out = t.groupBy(F.col("file_date").alias("date"), "company").agg(F.count_if(F.lower("label") == "negative").alias("neg"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("pct", F.round(F.col("neg") / F.col("total"), 4).cast("decimal(6,4)").cast("string"))


@query("agg_top_story_counts", """SELECT entity_type, entity_name, count(*) AS total, count(*) FILTER (WHERE sentiment_label = 'negative') AS negative FROM serp_feature_items
WHERE feature_type = 'top_stories_items' AND date BETWEEN DATE '2025-05-01' AND DATE '2025-05-31' GROUP BY 1, 2""")
def _stories(spark, sf):
    t = _items(spark, sf).filter("feature_type = 'top_stories_items' and date between date'2025-05-01' and date'2025-05-31'")
    return t.groupBy("entity_type", "entity_name").agg(F.count(F.lit(1)).alias("total"), F.count_if(_negative()).alias("negative"))


@query("agg_alert_candidates_day", """SELECT date, company, 'brand' AS scope, CAST(sum(negative_count) AS BIGINT) AS n FROM negative_articles_summary WHERE article_type = 'brand' GROUP BY 1, 2
UNION ALL SELECT date, company, 'all_ceos', CAST(sum(negative_count) AS BIGINT) FROM negative_articles_summary WHERE article_type <> 'brand' GROUP BY 1, 2""")
def _candidates(spark, sf):
    t = table(spark, sf, "negative_articles_summary")
    scope = F.when(F.col("article_type") == "brand", "brand").otherwise("all_ceos").alias("scope")
    return t.groupBy("date", "company", scope).agg(F.sum("negative_count").alias("n"))


@query("agg_pending_counts", """SELECT 'modal' AS table_name, count(*) AS n FROM ceo_articles_modal WHERE llm_label IS NULL AND uncertain
UNION ALL SELECT 'items', count(*) FROM serp_feature_items WHERE narrative_tagged_at IS NULL AND sentiment_label = 'negative'""")
def _pending(spark, sf):
    m = _modal(spark, sf).filter("llm_label is null and uncertain").agg(F.count(F.lit(1)).alias("n")).select(F.lit("modal").alias("table_name"), "n")
    i = _items(spark, sf).filter("narrative_tagged_at is null and sentiment_label = 'negative'").agg(F.count(F.lit(1)).alias("n"))
    return m.unionByName(i.select(F.lit("items").alias("table_name"), "n"))


@query("agg_query_payloads", """WITH v AS (SELECT nullif(trim(query), '') AS q, CASE WHEN json_valid(raw_json) THEN raw_json END AS j FROM raw_serps)
SELECT count(*) AS n_rows, count(DISTINCT q) AS queries, count(j) AS valid, count(DISTINCT CASE WHEN json_exists(j, '$.data') THEN q END) AS with_data,
count(DISTINCT CASE WHEN json_type(j, '$.data.organic_results') = 'ARRAY' AND json_array_length(j, '$.data.organic_results') > 0 THEN q END) AS with_organic FROM v""")
def _payloads(spark, sf):
    q = F.nullif(F.trim("query"), F.lit(""))
    v = table(spark, sf, "raw_serps").select(q.alias("q"), F.try_parse_json("raw_json").alias("j"))
    kind = F.schema_of_variant(F.try_variant_get("j", "$.data.organic_results", "variant"))
    some = kind.startswith("ARRAY") & F.try_variant_get("j", "$.data.organic_results[0]", "variant").isNotNull()
    return v.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("q").alias("queries"),
        F.count("j").alias("valid"),
        F.count_distinct(F.when(F.try_variant_get("j", "$.data", "variant").isNotNull(), F.col("q"))).alias("with_data"),
        F.count_distinct(F.when(some, F.col("q"))).alias("with_organic"),
    )


_CHANGES = """(SELECT edition, ceo, date, total - lag(total) OVER (PARTITION BY edition, ceo ORDER BY date) AS change FROM
(SELECT edition, ceo, date, arg_max(coalesce(total, 0), load_id) AS total FROM ceo_articles_daily_counts_chart GROUP BY 1, 2, 3))"""


@query("agg_market", f"""SELECT edition, count(change) AS n, count(*) FILTER (WHERE change > 0) AS up, count(*) FILTER (WHERE change < 0) AS down, CAST(sum(change) AS BIGINT) AS moved FROM {_CHANGES} GROUP BY 1""")
def _market(spark, sf):
    t = table(spark, sf, "ceo_articles_daily_counts_chart").select("edition", "ceo", "date", "load_id", F.coalesce("total", F.lit(0)).alias("total"))
    daily = merge.dedupe(t, ["edition", "ceo", "date"], "load_id")
    w = Window.partitionBy("edition", "ceo").orderBy("date")
    c = daily.withColumn("change", F.col("total") - F.lag("total").over(w))
    return c.groupBy("edition").agg(F.count("change").alias("n"), F.count_if(F.col("change") > 0).alias("up"), F.count_if(F.col("change") < 0).alias("down"), F.sum("change").cast("bigint").alias("moved"))


_TAGS = """(SELECT entity_name, narrative_primary_tag AS tag, CASE WHEN min(narrative_primary_group) = 'crisis' THEN 0 ELSE 1 END AS rank, count(*) AS n FROM serp_feature_items
WHERE narrative_primary_tag IS NOT NULL GROUP BY 1, 2)"""


def ordered_tags(df: DataFrame, keys: list[str], tag: str, group: Column, first: str) -> DataFrame:
    """``(keys, tags)``: tags with their counts, most frequent first, those of group ``first`` before others of the count, then by name."""
    n = df.filter(F.col(tag).isNotNull()).groupBy(*keys, F.col(tag).alias("tag")).agg(F.count(F.lit(1)).alias("n"), F.min(group).alias("g"))
    entry = F.struct((-F.col("n")).alias("o"), F.when(F.col("g") == first, 0).otherwise(1).alias("rank"), "tag")
    listed = F.array_sort(F.collect_list(entry))
    return n.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda e: F.concat(e["tag"], F.lit(":"), -e["o"])), "|").alias("tags"))


@query("agg_tag_order", f"SELECT entity_name, string_agg(tag || ':' || n, '|' ORDER BY n DESC, rank, tag) AS tags FROM {_TAGS} GROUP BY 1")
def _tag_order(spark, sf):
    return ordered_tags(_items(spark, sf), ["entity_name"], "narrative_primary_tag", F.col("narrative_primary_group"), "crisis")


@query("nar_rollup_event", f"SELECT entity_name, first(tag ORDER BY n DESC, rank, tag) AS tag, CAST(sum(n) AS BIGINT) AS n FROM {_TAGS} GROUP BY 1")
def _event_tag(spark, sf):
    t = _items(spark, sf).filter("narrative_primary_tag is not null")
    n = t.groupBy("entity_name", F.col("narrative_primary_tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"), F.min("narrative_primary_group").alias("g"))
    order = F.struct(-F.col("n"), F.when(F.col("g") == "crisis", 0).otherwise(1), "tag")
    return n.groupBy("entity_name").agg(F.min_by("tag", order).alias("tag"), F.sum("n").alias("n"))


@query("nar_backfill", """SELECT item_id, CASE WHEN date >= DATE '2025-12-01' THEN CASE WHEN sentiment_label = 'negative' AND NOT finance_routine THEN coalesce(narrative_primary_tag, 'Other') END ELSE narrative_primary_tag END AS tag FROM serp_feature_items""")
def _backfill(spark, sf):
    t = _items(spark, sf).select("item_id", "date", "sentiment_label", "finance_routine", F.col("narrative_primary_tag").alias("tag"))
    again = t.filter("date >= date'2025-12-01'").withColumn("tag", F.when(_negative() & ~F.col("finance_routine"), F.coalesce("tag", F.lit("Other"))))
    return merge.replace_window(t, again, "date", "2025-12-01", "9999-01-01").select("item_id", "tag")


# --- windows and order -------------------------------------------------------


@query("win_position_zip", """WITH a AS (SELECT entity_name, date, title, row_number() OVER (PARTITION BY entity_name, date ORDER BY position NULLS LAST, item_id) AS n FROM serp_feature_items WHERE feature_type = 'top_stories_items'),
b AS (SELECT entity_name, date, url, row_number() OVER (PARTITION BY entity_name, date ORDER BY position NULLS LAST, item_id) AS n FROM serp_feature_items WHERE feature_type <> 'top_stories_items')
SELECT a.entity_name, a.date, a.n, a.title, b.url FROM a JOIN b ON b.entity_name = a.entity_name AND b.date = a.date AND b.n = a.n""")
def _zip(spark, sf):
    t = _items(spark, sf)
    w = Window.partitionBy("entity_name", "date").orderBy(F.col("position").asc_nulls_last(), "item_id")
    n = F.row_number().over(w).cast("bigint").alias("n")
    a = t.filter("feature_type = 'top_stories_items'").select("entity_name", "date", "title", n)
    b = t.filter("feature_type != 'top_stories_items'").select("entity_name", "date", "url", n)
    return a.join(b, ["entity_name", "date", "n"])


@query("srt_alert_order", "SELECT summary_id, row_number() OVER (PARTITION BY date ORDER BY serp_neg_uncontrolled DESC, risk_score DESC, summary_id) AS place FROM negative_articles_summary")
def _alert_order(spark, sf):
    w = Window.partitionBy("date").orderBy(F.col("serp_neg_uncontrolled").desc(), F.col("risk_score").desc(), "summary_id")
    return table(spark, sf, "negative_articles_summary").select("summary_id", F.row_number().over(w).cast("bigint").alias("place"))


@query("srt_sample", "SELECT item_id, title FROM serp_feature_items WHERE sentiment_label = 'negative' ORDER BY date DESC, item_id LIMIT 15")
def _sample(spark, sf):
    return _items(spark, sf).filter(_negative()).orderBy(F.col("date").desc(), "item_id").limit(15).select("item_id", "title")


@query("alert_force", """SELECT company, article_type, summary_id FROM (SELECT *, row_number() OVER (PARTITION BY company, article_type, ceo ORDER BY date DESC, summary_id DESC) AS rn FROM negative_articles_summary
WHERE company IN (SELECT name FROM companies WHERE favorite)) WHERE rn = 1""")
def _force(spark, sf):
    wanted = table(spark, sf, "companies").filter("favorite").select(F.col("name").alias("company")).distinct()
    s = table(spark, sf, "negative_articles_summary").join(small(wanted), "company", "left_semi")
    best = s.groupBy("company", "article_type", "ceo").agg(F.max(F.struct("date", "summary_id")).alias("b"))
    return best.select("company", "article_type", "b.summary_id")


@query("alert_items", """SELECT date, entity_name, string_agg(title, ' | ' ORDER BY position NULLS LAST, item_id) AS titles, count(*) AS n FROM serp_feature_items
WHERE feature_type = 'top_stories_items' AND sentiment_label = 'negative' GROUP BY 1, 2""")
def _alert_items(spark, sf):
    t = _items(spark, sf).filter(_negative() & (F.col("feature_type") == "top_stories_items"))
    entry = F.struct(F.col("position").isNull().alias("none"), "position", "item_id", "title")
    listed = F.array_sort(F.collect_list(entry))
    return t.groupBy("date", "entity_name").agg(F.array_join(F.transform(listed, lambda e: e["title"]), " | ").alias("titles"), F.count(F.lit(1)).alias("n"))


# --- dimensions ----------------------------------------------------------------

_FKEY = f"trim(regexp_replace(lower(trim(regexp_replace(trim(name), '{LEGAL_TAILS}', ''))), '[^a-z0-9\\s]', '', 'g'))"


@query("dim_company_map", f"SELECT k, arg_max(id, id) AS id, arg_max(coalesce(sector, ''), id) AS sector FROM (SELECT id, sector, {_FKEY} AS k FROM companies) GROUP BY 1")
def _company_map(spark, sf):
    k = table(spark, sf, "companies").select(names.feature_key(F.col("name")).alias("k"), "id", F.coalesce("sector", F.lit("")).alias("sector"))
    return merge.dedupe(k, ["k"], "id")


@query("dim_ceo_map", "SELECT lower(trim(c.name)) AS k, c.company_id, c.id, k.name AS company FROM ceos c JOIN companies k ON k.id = c.company_id")
def _ceo_map(spark, sf):
    k = table(spark, sf, "companies").select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    c = table(spark, sf, "ceos").select(F.lower(F.trim("name")).alias("k"), "company_id", "id")
    return c.join(small(k), "company_id").select("k", "company_id", "id", "company")


@query("dim_industry", "SELECT m.row_id, coalesce(k.sector, '') AS industry FROM ceo_articles_modal m LEFT JOIN (SELECT name, max(sector) AS sector FROM companies GROUP BY 1) k ON k.name = m.company")
def _industry(spark, sf):
    k = table(spark, sf, "companies").groupBy(F.col("name").alias("company")).agg(F.max("sector").alias("sector"))
    return _modal(spark, sf).join(small(k), "company", "left").select("row_id", F.coalesce("sector", F.lit("")).alias("industry"))


@query("dim_ceo_by_company", "SELECT company_id, id, row_number() OVER (PARTITION BY company_id ORDER BY lower(name), id) AS place FROM ceos")
def _ceo_by_company(spark, sf):
    w = Window.partitionBy("company_id").orderBy(F.lower("name"), "id")
    return table(spark, sf, "ceos").select("company_id", "id", F.row_number().over(w).cast("bigint").alias("place"))


@query("dim_entity_map", "SELECT entity_type, entity_name, min(entity_id) AS id FROM serp_feature_items WHERE entity_id IS NOT NULL GROUP BY 1, 2")
def _entity_map(spark, sf):
    return _items(spark, sf).filter("entity_id is not null").groupBy("entity_type", "entity_name").agg(F.min("entity_id").alias("id"))


@query("dim_resolve_entity", """SELECT i.item_id, CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL AND a.id <> b.id THEN 'disagree' WHEN coalesce(a.id, b.id) IS NULL THEN 'absent' ELSE 'found' END AS status,
CASE WHEN a.id IS NULL OR b.id IS NULL OR a.id = b.id THEN coalesce(a.id, b.id) END AS id
FROM serp_feature_items i LEFT JOIN companies a ON a.id = i.entity_id LEFT JOIN (SELECT name, min(id) AS id FROM companies GROUP BY 1) b ON b.name = i.entity_name""")
def _resolve_entity(spark, sf):
    k = table(spark, sf, "companies")
    by_id = small(k.select(F.col("id").alias("a"), F.col("id").alias("entity_id")))
    by_name = small(k.groupBy(F.col("name").alias("entity_name")).agg(F.min("id").alias("b")))
    j = _items(spark, sf).select("item_id", "entity_id", "entity_name").join(by_id, "entity_id", "left").join(by_name, "entity_name", "left")
    clash = F.coalesce(F.col("a") != F.col("b"), F.lit(False))
    one = F.coalesce("a", "b")
    return j.select("item_id", F.when(clash, "disagree").when(one.isNull(), "absent").otherwise("found").alias("status"), F.when(~clash, one).alias("id"))


@query("src_roster_stock", "SELECT id, name, ticker AS stock FROM companies WHERE nullif(trim(ticker), '') IS NOT NULL AND nullif(trim(name), '') IS NOT NULL")
def _roster_stock(spark, sf):
    k = table(spark, sf, "companies").withColumnRenamed("ticker", "stock")
    return k.filter((F.trim("stock") != "") & (F.trim("name") != "")).select("id", "name", "stock")


@query("src_legacy_rows", """SELECT row_id, coalesce(ceo, company) AS entity, title, md5(url) AS hash, CASE lower(sentiment) WHEN 'negative' THEN 'risk' WHEN 'positive' THEN 'no_risk' WHEN 'neutral' THEN 'no_risk' END AS label
FROM ceo_articles_modal WHERE nullif(trim(coalesce(ceo, company)), '') IS NOT NULL AND nullif(trim(title), '') IS NOT NULL AND nullif(trim(url), '') IS NOT NULL""")
def _legacy(spark, sf):
    entity = F.coalesce("ceo", "company")
    m = _modal(spark, sf).filter((F.trim(entity) != "") & (F.trim("title") != "") & (F.trim("url") != ""))
    low = F.lower("sentiment")
    label = F.when(low == "negative", "risk").when(low.isin("positive", "neutral"), "no_risk")
    return m.select("row_id", entity.alias("entity"), "title", F.md5("url").alias("hash"), label.alias("label"))


# --- staging, evidence, events ---------------------------------------------------


@query("ev_stage", """SELECT item_id, md5(coalesce(nullif(url, ''), title)) AS hash, coalesce(control_class, 'uncontrolled') AS control,
CASE WHEN finance_routine AND sentiment_label IN ('positive', 'negative') THEN 'neutral' ELSE sentiment_label END AS label,
coalesce(feature_type = 'top_stories_items' AND sentiment_label = 'negative' AND NOT finance_routine, false) AS neg_story FROM serp_feature_items""")
def _stage(spark, sf):
    routine = F.col("finance_routine") & F.col("sentiment_label").isin("positive", "negative")
    story = (F.col("feature_type") == "top_stories_items") & _negative() & ~F.col("finance_routine")
    return _items(spark, sf).select(
        "item_id",
        F.md5(F.coalesce(F.nullif("url", F.lit("")), "title")).alias("hash"),
        F.coalesce("control_class", F.lit("uncontrolled")).alias("control"),
        F.when(routine, "neutral").otherwise(F.col("sentiment_label")).alias("label"),
        F.coalesce(story, F.lit(False)).alias("neg_story"),
    )


_EVIDENCE = """(SELECT entity, day, key, source FROM (SELECT *, row_number() OVER (PARTITION BY entity, day, key ORDER BY rank, id) AS rn FROM (
SELECT entity_name AS entity, date AS day, CASE WHEN trim(url) <> '' THEN lower(trim(url)) ELSE lower(trim(title) || '::' || coalesce(trim(source), '')) END AS key, 'story' AS source, 0 AS rank, item_id AS id
FROM serp_feature_items WHERE feature_type = 'top_stories_items' AND sentiment_label = 'negative' AND NOT finance_routine
UNION ALL SELECT company, file_date, CASE WHEN trim(url) <> '' THEN lower(trim(url)) ELSE lower(trim(title) || '::' || coalesce(trim(source), '')) END, 'article', 1, row_id
FROM ceo_articles_modal WHERE lower(sentiment) = 'negative' AND NOT finance_routine AND company IS NOT NULL)) WHERE rn = 1)"""


def _evidence(spark, sf):
    key = events.evidence_key(F.col("url"), F.col("title"), F.col("source"))
    stories = _items(spark, sf).filter(_negative() & ~F.col("finance_routine") & (F.col("feature_type") == "top_stories_items"))
    stories = stories.select(F.col("entity_name").alias("entity"), F.col("date").alias("day"), key.alias("key"), F.lit("story").alias("source"), F.lit(0).alias("rank"), F.col("item_id").alias("id"))
    articles = _modal(spark, sf).filter((F.lower("sentiment") == "negative") & ~F.col("finance_routine") & F.col("company").isNotNull())
    articles = articles.select(F.col("company").alias("entity"), F.col("file_date").alias("day"), key.alias("key"), F.lit("article").alias("source"), F.lit(1).alias("rank"), F.col("row_id").alias("id"))
    # the first of each key, combined before the shuffle
    both = stories.unionByName(articles).groupBy("entity", "day", "key").agg(F.min_by("source", F.struct("rank", "id")).alias("source"))
    return both


@query("crisis_evidence", f"SELECT entity, day, key, source FROM {_EVIDENCE}")
def _crisis_evidence(spark, sf):
    return _evidence(spark, sf)


@query("crisis_build", f"""WITH e AS (SELECT entity, day, count(*) FILTER (WHERE source = 'story') AS stories, count(*) FILTER (WHERE source = 'article') AS articles FROM {_EVIDENCE} GROUP BY 1, 2),
m AS (SELECT company AS entity, file_date AS day, count(*) AS total, count(*) FILTER (WHERE lower(sentiment) = 'negative') AS neg FROM ceo_articles_modal WHERE company IS NOT NULL GROUP BY 1, 2),
s AS (SELECT entity, day FROM e UNION SELECT entity, day FROM m),
f AS (SELECT s.entity, s.day, coalesce(m.total, 0) AS total, coalesce(m.neg, 0) AS neg, coalesce(e.stories, 0) AS stories, coalesce(e.articles, 0) AS articles
FROM s LEFT JOIN e ON e.entity = s.entity AND e.day = s.day LEFT JOIN m ON m.entity = s.entity AND m.day = s.day)
SELECT f.*, coalesce(p.total, 0) AS prev_total, coalesce(p.neg, 0) AS prev_neg, f.stories >= 2 AS top_stories,
f.total >= 5 AND 20 * (f.neg * (CASE WHEN p.total > 0 THEN p.total ELSE 1 END) - (CASE WHEN p.total > 0 THEN p.neg ELSE 0 END) * f.total) >= 4 * f.total * (CASE WHEN p.total > 0 THEN p.total ELSE 1 END)
AND f.neg - coalesce(p.neg, 0) >= 2 AND f.articles >= 2 AS newsfeed_delta FROM f LEFT JOIN f p ON p.entity = f.entity AND p.day = f.day - 1""")
def _crisis_build(spark, sf):
    e = _evidence(spark, sf).groupBy("entity", "day").agg(F.count_if(F.col("source") == "story").alias("stories"), F.count_if(F.col("source") == "article").alias("articles"))
    m = _modal(spark, sf).filter("company is not null").groupBy(F.col("company").alias("entity"), F.col("file_date").alias("day"))
    m = m.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.lower("sentiment") == "negative").alias("neg"))
    counts = ["total", "neg", "stories", "articles"]
    f = m.join(e, ["entity", "day"], "full_outer").fillna(0, counts).select("entity", "day", *counts)
    f = rollups.previous_day(f, ["entity"], "day", ["total", "neg"])
    t = events.triggers(F.col("total"), F.col("neg"), F.col("prev_total"), F.col("prev_neg"), F.col("stories"), F.col("articles"))
    return f.select("entity", "day", *counts, "prev_total", "prev_neg", t["top_stories"].alias("top_stories"), t["newsfeed_delta"].alias("newsfeed_delta"))


# --- entity merges and maintenance -----------------------------------------------

_PAIR = """(SELECT max(id) AS old, min(id) AS new FROM companies WHERE split_part(name, ' ', 1) =
(SELECT min(w) FROM (SELECT split_part(name, ' ', 1) AS w FROM companies GROUP BY 1 HAVING count(*) > 1)))"""


def _pair(spark, sf):
    k = table(spark, sf, "companies").select("id", F.split("name", " ")[0].alias("w"))
    pair = k.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("old"), F.min("id").alias("new")).filter("n > 1")
    return pair.agg(F.min_by(F.struct("old", "new"), "w").alias("p")).select("p.old", "p.new")


@query("mrg_move", f"SELECT c.id, CASE WHEN c.company_id = m.old THEN m.new ELSE c.company_id END AS company_id FROM ceos c CROSS JOIN {_PAIR} m")
def _move(spark, sf):
    moved = table(spark, sf, "ceos").join(F.broadcast(_pair(spark, sf)), F.col("company_id") == F.col("old"), "left")  # one row
    return moved.select("id", F.coalesce("new", "company_id").alias("company_id"))


@query("mrg_delete_named", """SELECT i.item_id FROM serp_feature_items i LEFT JOIN companies k ON k.id = 'none' WHERE NOT (i.date BETWEEN DATE '2025-03-01' AND DATE '2025-03-31'
AND (coalesce(i.entity_id, '') IN (SELECT id FROM companies WHERE favorite) OR i.entity_name IN (SELECT name FROM companies WHERE favorite)))""")
def _delete_named(spark, sf):
    gone = table(spark, sf, "companies").filter("favorite")
    ids = small(gone.select(F.col("id").alias("entity_id"), F.lit(True).alias("by_id")).distinct())
    called = small(gone.select(F.col("name").alias("entity_name"), F.lit(True).alias("by_name")).distinct())
    j = _items(spark, sf).select("item_id", "date", "entity_id", "entity_name").join(ids, "entity_id", "left").join(called, "entity_name", "left")
    named = F.coalesce("by_id", "by_name", F.lit(False))
    return j.filter(~(F.col("date").between("2025-03-01", "2025-03-31") & named)).select("item_id")


@query("mrg_items_runs", f"""WITH r AS (SELECT i.item_id, i.entity_id = m.old AS from_old, coalesce(CASE WHEN i.entity_id = m.old THEN m.new END, i.entity_id) AS entity_id, i.feature_type, i.url_hash, i.date
FROM serp_feature_items i CROSS JOIN {_PAIR} m WHERE i.entity_id IS NOT NULL)
SELECT item_id, entity_id, CASE WHEN NOT from_old THEN 'own' ELSE 'moved' END AS how FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, feature_type, url_hash, date ORDER BY from_old, item_id) AS rn FROM r) WHERE rn = 1""")
def _items_runs(spark, sf):
    i = _items(spark, sf).filter("entity_id is not null").select("item_id", "entity_id", "feature_type", "url_hash", "date")
    moved = i.join(F.broadcast(_pair(spark, sf)), F.col("entity_id") == F.col("old"), "left")
    named = moved.select("item_id", F.coalesce("new", "entity_id").alias("entity_id"), "feature_type", "url_hash", "date", F.when(F.col("old").isNotNull(), "moved").otherwise("own").alias("how"))
    rank = F.struct((F.col("how") == "moved").alias("m"), "item_id")
    return merge.dedupe(named, ["entity_id", "feature_type", "url_hash", "date"], rank, last=False).select("item_id", "entity_id", "how")


@query("mrg_rebuild", """WITH d AS (SELECT date, entity_name, feature_type, count(*) AS total_count, count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count FROM serp_feature_items GROUP BY 1, 2, 3)
SELECT date, entity_name, feature_type, total_count, negative_count, false AS rebuilt FROM d WHERE NOT date BETWEEN DATE '2025-04-01' AND DATE '2025-04-30'
UNION ALL SELECT date, entity_name, feature_type, count(*), count(*) FILTER (WHERE CASE WHEN finance_routine THEN 'neutral' ELSE sentiment_label END = 'negative'), true FROM serp_feature_items
WHERE date BETWEEN DATE '2025-04-01' AND DATE '2025-04-30' GROUP BY 1, 2, 3""")
def _rebuild(spark, sf):
    keys = ["date", "entity_name", "feature_type"]
    t = _items(spark, sf)
    kept = rollups.recompute_daily(t, keys, F.col("sentiment_label")).select(*keys, "total_count", "negative_count", F.lit(False).alias("rebuilt"))
    april = t.filter("date between date'2025-04-01' and date'2025-04-30'")
    label = F.when(F.col("finance_routine"), "neutral").otherwise(F.col("sentiment_label"))
    fresh = rollups.recompute_daily(april, keys, label).select(*keys, "total_count", "negative_count", F.lit(True).alias("rebuilt"))
    return merge.replace_window(kept, fresh, "date", "2025-04-01", "2025-05-01")


@query("mnt_backfill_daily", """SELECT company, count(*) AS total, count(*) FILTER (WHERE lower(coalesce(nullif(trim(llm_label), ''), sentiment)) = 'negative') AS negative
FROM ceo_articles_modal WHERE file_date = DATE '2025-06-03' AND company IS NOT NULL GROUP BY 1""")
def _backfill_daily(spark, sf):
    m = _modal(spark, sf).filter("file_date = date'2025-06-03' and company is not null")
    label = F.lower(F.coalesce(F.nullif(F.trim("llm_label"), F.lit("")), "sentiment"))
    return m.groupBy("company").agg(F.count(F.lit(1)).alias("total"), F.count_if(label == "negative").alias("negative"))


@query("mnt_match_report", """SELECT CASE WHEN e.name IS NOT NULL THEN 'exact' WHEN l.k IS NOT NULL THEN 'any case' ELSE 'unmatched' END AS tier, count(*) AS n, count(DISTINCT m.company) AS names
FROM ceo_articles_modal m LEFT JOIN (SELECT DISTINCT name FROM companies) e ON e.name = m.company LEFT JOIN (SELECT DISTINCT lower(name) AS k FROM companies) l ON l.k = lower(m.company) WHERE m.company IS NOT NULL GROUP BY 1""")
def _match_report(spark, sf):
    k = table(spark, sf, "companies")
    exact = small(k.select(F.col("name").alias("company"), F.lit(True).alias("e")).distinct())
    low = small(k.select(F.lower("name").alias("low"), F.lit(True).alias("l")).distinct())
    m = _modal(spark, sf).filter("company is not null").groupBy("company").agg(F.count(F.lit(1)).alias("c"))
    tier = F.when(F.col("e"), "exact").when(F.col("l"), "any case").otherwise("unmatched").alias("tier")
    j = m.join(exact, "company", "left").withColumn("low", F.lower("company")).join(low, "low", "left")
    return j.groupBy(tier).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("names"))


@query("guard_min_queries", """SELECT n >= greatest(100, floor(0.5 * roster)) AS enough_raw, mapped >= greatest(100, floor(0.4 * roster)) AS enough_mapped FROM
(SELECT count(DISTINCT nullif(trim(query), '')) AS n, count(DISTINCT CASE WHEN k.name IS NOT NULL THEN query END) AS mapped FROM raw_serps r LEFT JOIN (SELECT DISTINCT name FROM companies) k ON k.name = r.query) q,
(SELECT count(*) AS roster FROM companies) c""")
def _guard(spark, sf):
    k = table(spark, sf, "companies").select(F.col("name").alias("query"), F.lit(True).alias("known")).distinct()
    r = table(spark, sf, "raw_serps").select("query").join(small(k), "query", "left")
    n = r.agg(F.count_distinct(F.nullif(F.trim("query"), F.lit(""))).alias("n"), F.count_distinct(F.when(F.col("known"), F.col("query"))).alias("mapped"))
    both = n.crossJoin(F.broadcast(table(spark, sf, "companies").agg(F.count(F.lit(1)).alias("roster"))))  # one row each
    least = lambda share: F.greatest(F.lit(100), F.floor(share * F.col("roster")))
    return both.select((F.col("n") >= least(0.5)).alias("enough_raw"), (F.col("mapped") >= least(0.4)).alias("enough_mapped"))


# --- enrichment --------------------------------------------------------------------

#: Labels an enrichment may give.
LABELS = ("negative", "neutral", "positive")


@query("llm_queue", """SELECT row_id, place FROM (SELECT row_id, row_number() OVER (PARTITION BY file_date ORDER BY CASE WHEN lower(sentiment) = 'negative' THEN 0 ELSE 1 END, length(title), row_id) AS place
FROM ceo_articles_modal WHERE uncertain AND llm_label IS NULL) WHERE place <= 20""")
def _llm_queue(spark, sf):
    m = _modal(spark, sf).filter("uncertain and llm_label is null")
    w = Window.partitionBy("file_date").orderBy(F.when(F.lower("sentiment") == "negative", 0).otherwise(1), F.length("title"), "row_id")
    return m.withColumn("place", F.row_number().over(w).cast("bigint")).filter("place <= 20").select("row_id", "place")


@query("llm_validate", "SELECT row_id, CASE WHEN lower(trim(llm_label)) IN ('negative', 'neutral', 'positive') THEN lower(trim(llm_label)) END AS label FROM ceo_articles_modal")
def _llm_validate(spark, sf):
    low = F.lower(F.trim("llm_label"))
    return _modal(spark, sf).select("row_id", F.when(low.isin(*LABELS), low).alias("label"))


@query("llm_apply", """SELECT m.row_id, CASE WHEN o.url IS NOT NULL THEN o.label ELSE m.llm_label END AS llm_label, CASE WHEN o.url IS NOT NULL THEN o.severity ELSE m.llm_severity END AS llm_severity FROM ceo_articles_modal m
LEFT JOIN (SELECT url, arg_max(sentiment, row_id) AS label, 'low' AS severity FROM ceo_articles_modal WHERE uncertain GROUP BY 1) o ON o.url = m.url""")
def _llm_apply(spark, sf):
    m = _modal(spark, sf)
    answers = m.filter("uncertain").groupBy("url").agg(F.max_by("sentiment", "row_id").alias("llm_label")).withColumn("llm_severity", F.lit("low"))
    return merge.update_from(m.select("row_id", "url", "llm_label", "llm_severity"), answers, ["url"], ["llm_label", "llm_severity"]).drop("url")


@query("rule_renormalize", "SELECT item_id, CASE WHEN finance_routine AND sentiment_label IN ('positive', 'negative') THEN 'neutral' ELSE sentiment_label END AS label FROM serp_feature_items")
def _renormalize(spark, sf):
    routine = F.col("finance_routine") & F.col("sentiment_label").isin("positive", "negative")
    return _items(spark, sf).select("item_id", F.when(routine, "neutral").otherwise(F.col("sentiment_label")).alias("label"))


@query("rule_uncertain_score", """SELECT summary_id, 1 - least(abs(risk_score) / 100, 1.0) + CASE WHEN len(list_filter(regexp_split_to_array(trim(coalesce(top_headlines, '')), '\\s+'), lambda w: w <> '')) <= 6 THEN 0.5 ELSE 0 END AS score FROM negative_articles_summary""")
def _uncertain_score(spark, sf):
    words = F.size(F.filter(F.split(F.trim(F.coalesce("top_headlines", F.lit(""))), r"\s+"), lambda w: w != ""))
    score = 1 - F.least(F.abs("risk_score") / 100, F.lit(1.0)) + F.when(words <= 6, 0.5).otherwise(0)
    return table(spark, sf, "negative_articles_summary").select("summary_id", score.alias("score"))


@query("crm_contact_score", """SELECT id, (CASE WHEN regexp_matches(lower(title), 'chief|president') THEN 60 ELSE 0 END) + (CASE WHEN regexp_matches(lower(title), 'media|press|news') THEN 30 ELSE 0 END)
+ (CASE WHEN regexp_matches(lower(title), 'report|brand') THEN 20 ELSE 0 END) AS score FROM articles""")
def _contact(spark, sf):
    return table(spark, sf, "articles").select("id", pattern_score(F.lower("title"), {"chief|president": 60, "media|press|news": 30, "report|brand": 20}).alias("score"))


def pattern_score(text: Column, points: dict[str, int]) -> Column:
    """Sum of the points of all patterns found in a text."""
    score = F.lit(0)
    for pattern, value in points.items():
        score = score + F.when(text.rlike(pattern), value).otherwise(0)
    return score


@query("alert_jitter")
def _jitter(spark, sf):
    """When an alert is entered in the history: up to six hours later, by a hash of its key, the same in any run."""
    s = table(spark, sf, "negative_articles_summary")
    late = F.pmod(F.xxhash64("summary_id"), F.lit(6 * 3600))
    return s.select("summary_id", F.timestamp_seconds(F.unix_seconds(F.to_timestamp("date")) + late).alias("sent_at"))
