"""Queries of the reference operators over the domain tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import casts, names, series, urls
from tidemark.functions.vader import compound
from tidemark.operators import events, features, merge, resolve, rollups
from tidemark.plans import maintain, rules, selection
from tidemark.session import shared_folder, small, table
from tidemark.sources import readers, writers

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


# --- sources and sinks -----------------------------------------------------


@query("src_raw_payloads", "SELECT query, raw_json FROM raw_serps")
def _src_raw(spark, sf):
    return readers.raw_payloads(spark, f"{sf}/raw_serps.parquet")


@query("src_date_range", "SELECT unnest(generate_series(DATE '2025-01-01', DATE '2025-03-31', INTERVAL 1 DAY))::DATE AS date")
def _src_dates(spark, sf):
    return readers.dates_between(spark, "2025-01-01", "2025-03-31")


@query(
    "src_roster_first",
    """SELECT ceo, company FROM (SELECT c.name AS ceo, k.name AS company, row_number() OVER (PARTITION BY c.name ORDER BY k.name, c.id) AS rn
       FROM ceos c JOIN companies k ON k.id = c.company_id) WHERE rn = 1""",
)
def _src_roster(spark, sf):
    c = table(spark, sf, "ceos").select(F.col("id").alias("cid"), F.col("name").alias("ceo"), "company_id")
    k = table(spark, sf, "companies").select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    return merge.dedupe(c.join(small(k), "company_id"), ["ceo"], F.struct("company", "cid"), last=False).select("ceo", "company")


@query("src_capped_feed", "SELECT id, publisher FROM (SELECT id, publisher, row_number() OVER (PARTITION BY publisher ORDER BY id) AS rn FROM articles WHERE publisher IS NOT NULL) WHERE rn <= 50")
def _src_cap(spark, sf):
    a = table(spark, sf, "articles").filter("publisher is not null").select("id", "publisher")
    return selection.budgeted(a, ["publisher"], [F.col("id")], 50).select("id", "publisher")


@query("src_html_text", "SELECT id, trim(regexp_replace(regexp_replace(replace(replace(replace('<p class=\"x\">' || coalesce(title, '') || '</p><b>' || coalesce(snippet, '') || '</b>', '&nbsp;', ' '), '&#x27;', ''''), '&amp;', '&'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM articles")
def _src_html(spark, sf):
    html = F.concat(F.lit('<p class="x">'), F.coalesce("title", F.lit("")), F.lit("</p><b>"), F.coalesce("snippet", F.lit("")), F.lit("</b>"))
    return table(spark, sf, "articles").select("id", readers.html_text(html).alias("text"))


@query("src_source_name", "SELECT id, CASE WHEN trim(coalesce(publisher, '')) <> '' THEN trim(publisher) ELSE replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), 'www.', '') END AS source FROM articles")
def _src_name(spark, sf):
    return table(spark, sf, "articles").select("id", readers.source_name(F.col("publisher"), F.col("url")).alias("source"))


@query("snk_unmatched", "SELECT company, count(*) AS n FROM ceo_articles_modal m WHERE company IS NOT NULL AND NOT EXISTS (SELECT 1 FROM companies c WHERE c.name = m.company) GROUP BY company")
def _snk_unmatched(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").filter("company is not null")
    return writers.unmatched(m, "company", table(spark, sf, "companies"), "name")


@query("snk_add_columns", "SELECT id, name, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BIGINT) AS weight FROM companies")
def _snk_add(spark, sf):
    return writers.add_columns(table(spark, sf, "companies").select("id", "name"), {"note": "string", "weight": "bigint", "name": "string"})


@query("snk_month_partition", "SELECT strftime(date, '%Y-%m') AS ym, count(*) AS n FROM serp_feature_items GROUP BY 1")
def _snk_month(spark, sf):
    path = f"{shared_folder(spark)}/months-{uuid.uuid4().hex}"
    writers.write_months(table(spark, sf, "serp_feature_items").select("item_id", "date"), path)
    # the partition is text; as a directory's name it would be read as a date
    written = spark.read.schema("item_id bigint, date date, ym string").parquet(path)
    return written.groupBy("ym").agg(F.count(F.lit(1)).alias("n"))


@query("snk_retention", "SELECT item_id, date FROM serp_feature_items WHERE date >= date_trunc('month', DATE '2025-12-15' - INTERVAL 4 MONTH)")
def _snk_retention(spark, sf):
    return merge.retain_months(table(spark, sf, "serp_feature_items"), "date", 4, F.lit("2025-12-15").cast("date")).select("item_id", "date")


# --- merges ----------------------------------------------------------------

_CHART_KEY = "edition, ceo, date"


@query("ups_dedupe_last", f"SELECT edition, ceo, date, max(load_id) AS load_id, arg_max(total, load_id) AS total FROM (SELECT *, 1 FROM ceo_articles_daily_counts_chart WHERE total IS NOT NULL) GROUP BY {_CHART_KEY}")
def _ups_last(spark, sf):
    c = table(spark, sf, "ceo_articles_daily_counts_chart").filter("total is not null").select("edition", "ceo", "date", "load_id", "total")
    return merge.dedupe(c, ["edition", "ceo", "date"], "load_id")


def _halves(spark, sf):
    """All articles of the history and of later batches, keyed by their title: the last of each."""
    a = table(spark, sf, "articles").select(F.col("title").alias("k"), "id", "publisher", "snippet", "first_seen_at", "last_seen_at", "batch_no")
    old = merge.dedupe(a.filter("batch_no = 0"), ["k"], "id").drop("batch_no")
    new = merge.dedupe(a.filter("batch_no > 0"), ["k"], "id").drop("batch_no")
    return old, new


_HALVES = """
WITH a AS (SELECT title AS k, * FROM articles),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id DESC) AS rn FROM a WHERE batch_no = 0) WHERE rn = 1),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id DESC) AS rn FROM a WHERE batch_no > 0) WHERE rn = 1)
"""


@query("ups_overwrite", _HALVES + "SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.id ELSE o.id END AS id, CASE WHEN n.k IS NOT NULL THEN n.publisher ELSE o.publisher END AS publisher FROM o FULL JOIN n ON o.k = n.k")
def _ups_overwrite(spark, sf):
    old, new = _halves(spark, sf)
    return merge.merge(old.select("k", "id", "publisher"), new.select("k", "id", "publisher"), ["k"])


@query("ups_coalesce_new", _HALVES + "SELECT coalesce(n.k, o.k) AS k, coalesce(n.publisher, o.publisher) AS publisher, coalesce(n.snippet, o.snippet) AS snippet FROM o FULL JOIN n ON o.k = n.k")
def _ups_fill(spark, sf):
    old, new = _halves(spark, sf)
    cols = ["k", "publisher", "snippet"]
    return merge.merge(old.select(*cols), new.select(*cols), ["k"], default="fill")


@query("ups_min_max_seen", _HALVES + "SELECT coalesce(n.k, o.k) AS k, least(n.first_seen_at, o.first_seen_at) AS first_seen_at, greatest(n.last_seen_at, o.last_seen_at) AS last_seen_at FROM o FULL JOIN n ON o.k = n.k")
def _ups_seen(spark, sf):
    old, new = _halves(spark, sf)
    cols = ["k", "first_seen_at", "last_seen_at"]
    return merge.merge(old.select(*cols), new.select(*cols), ["k"], {"first_seen_at": "least", "last_seen_at": "greatest"})


@query("ups_do_nothing", _HALVES + "SELECT k, id FROM o UNION ALL SELECT k, id FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.k = n.k)")
def _ups_nothing(spark, sf):
    old, new = _halves(spark, sf)
    return merge.insert_new(old.select("k", "id"), new.select("k", "id"), ["k"])


@query("ups_replace_window", "SELECT item_id, date FROM serp_feature_items WHERE NOT (date >= DATE '2025-06-01' AND date < DATE '2025-07-01' AND entity_type = 'ceo') UNION ALL SELECT -item_id, date FROM serp_feature_items WHERE date = DATE '2025-06-02' AND entity_type = 'ceo'")
def _ups_window(spark, sf):
    t = table(spark, sf, "serp_feature_items").select("item_id", "date", "entity_type")
    fresh = t.filter("date = date'2025-06-02' and entity_type = 'ceo'").withColumn("item_id", -F.col("item_id"))
    return merge.replace_window(t, fresh, "date", "2025-06-01", "2025-07-01", F.col("entity_type") == "ceo").select("item_id", "date")


@query("ups_update_from", _HALVES + "SELECT o.k, o.id, CASE WHEN n.k IS NOT NULL THEN n.publisher ELSE o.publisher END AS publisher FROM o LEFT JOIN n ON o.k = n.k")
def _ups_update(spark, sf):
    old, new = _halves(spark, sf)
    return merge.update_from(old.select("k", "id", "publisher"), new.select("k", "publisher"), ["k"], ["publisher"])


@query("ups_delete_using", _HALVES + "SELECT k, id FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.k = o.k)")
def _ups_delete(spark, sf):
    old, new = _halves(spark, sf)
    return merge.delete_matching(old.select("k", "id"), new, ["k"])


def _pages(spark, sf):
    """All articles of the history and of later batches under the page their link leads to; a row without a link is a page of its own."""
    a = table(spark, sf, "articles")
    page = F.coalesce(F.nullif(urls.normalize(F.col("url")), F.lit("")), F.concat(F.lit("#"), F.col("id")))
    a = a.select(page.alias("page"), "id", "publisher", "snippet", "first_seen_at", "last_seen_at", "batch_no")
    return a.filter("batch_no = 0").drop("batch_no"), a.filter("batch_no > 0").drop("batch_no")


@query("ups_overwrite_pages")
def _ups_overwrite_pages(spark, sf):
    old, new = (merge.dedupe(x.select("page", "id", "publisher"), ["page"], "id") for x in _pages(spark, sf))
    return merge.merge(old, new, ["page"])


@query("ups_coalesce_new_pages")
def _ups_fill_pages(spark, sf):
    # a page's own rows fill each other in the order of arrival, as they would one by one
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct("id", c)))[c].alias(c) for c in ("publisher", "snippet")]
    old, new = (x.groupBy("page").agg(*last) for x in _pages(spark, sf))
    return merge.merge(old, new, ["page"], default="fill")


@query("ups_min_max_seen_pages")
def _ups_seen_pages(spark, sf):
    seen = [F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at")]
    old, new = (x.groupBy("page").agg(*seen) for x in _pages(spark, sf))
    return merge.merge(old, new, ["page"], {"first_seen_at": "least", "last_seen_at": "greatest"})


@query("ups_do_nothing_pages")
def _ups_nothing_pages(spark, sf):
    old, new = (merge.dedupe(x.select("page", "id"), ["page"], "id", last=False) for x in _pages(spark, sf))
    return merge.insert_new(old, new, ["page"])


@query("ups_update_from_pages")
def _ups_update_pages(spark, sf):
    old, new = _pages(spark, sf)
    return merge.update_from(old.select("page", "id", "publisher"), merge.dedupe(new.select("page", "id", "publisher"), ["page"], "id"), ["page"], ["publisher"])


@query("ups_delete_using_pages")
def _ups_delete_pages(spark, sf):
    old, new = _pages(spark, sf)
    return merge.delete_matching(old.select("page", "id"), new, ["page"])


@query("ups_insert_select", "SELECT v.ceo AS name, k.id AS company_id FROM (SELECT DISTINCT ceo, company FROM ceo_articles_daily_counts_chart) v JOIN companies k ON k.name = v.company")
def _ups_insert(spark, sf):
    v = table(spark, sf, "ceo_articles_daily_counts_chart").select("ceo", "company").distinct()
    k = table(spark, sf, "companies").select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    return v.join(small(k), "company").select(F.col("ceo").alias("name"), "company_id")


@query("ups_surrogate_id", "SELECT id, sha256(coalesce(url, chr(0)) || chr(31) || coalesce(publisher, chr(0))) AS sid FROM articles WHERE publisher IS NOT NULL")
def _ups_id(spark, sf):
    a = table(spark, sf, "articles").filter("publisher is not null")
    return a.select("id", merge.surrogate(F.col("url"), F.col("publisher")).alias("sid"))


@query("ups_partial_unique", """WITH u AS (SELECT *, date >= DATE '2025-07-01' AS fresh FROM serp_feature_items)
SELECT item_id, entity_type, sentiment_label FROM u WHERE entity_type <> 'company' UNION ALL
SELECT item_id, entity_type, sentiment_label FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(entity_id, entity_name), feature_type, url_hash ORDER BY fresh DESC, item_id DESC) AS rn FROM u WHERE entity_type = 'company') WHERE rn = 1""")
def _ups_partial(spark, sf):
    t = table(spark, sf, "serp_feature_items").select("item_id", "date", "entity_type", "sentiment_label", F.coalesce("entity_id", "entity_name").alias("entity"), "feature_type", "url_hash")
    cut = F.lit("2025-07-01").cast("date")
    key = ["entity", "feature_type", "url_hash"]
    out = merge.partial_upsert(t.filter(F.col("date") < cut), t.filter(F.col("date") >= cut), key, F.col("entity_type") == "company", "item_id")
    return out.select("item_id", "entity_type", "sentiment_label")


# --- projections, filters, casts -------------------------------------------


@query("prj_effective_label", "SELECT row_id, coalesce(CASE WHEN row_id % 7 = 0 THEN 'override' END, CASE WHEN llm_severity = 'high' THEN 'negative' END, sentiment) AS label FROM ceo_articles_modal")
def _prj_label(spark, sf):
    m = table(spark, sf, "ceo_articles_modal")
    over = F.when(F.col("row_id") % 7 == 0, "override")
    return m.select("row_id", rollups.effective_label(over, F.when(F.col("llm_severity") == "high", "negative"), F.col("sentiment")).alias("label"))


@query("prj_case_flag", "SELECT item_id, CASE WHEN sentiment_label = 'negative' THEN 1 ELSE 0 END AS neg, 'brand' AS scope FROM serp_feature_items")
def _prj_flag(spark, sf):
    t = table(spark, sf, "serp_feature_items")
    return t.select("item_id", F.when(F.col("sentiment_label") == "negative", 1).otherwise(0).alias("neg"), F.lit("brand").alias("scope"))


@query("flt_between_lookback", "SELECT item_id FROM serp_feature_items WHERE date BETWEEN DATE '2025-09-30' - 30 AND DATE '2025-09-30' AND feature_type IN ('aio_citations', 'top_stories_items') AND url LIKE '%example%'")
def _flt_between(spark, sf):
    t = table(spark, sf, "serp_feature_items")
    end = F.lit("2025-09-30").cast("date")
    return t.filter(F.col("date").between(F.date_sub(end, 30), end) & F.col("feature_type").isin("aio_citations", "top_stories_items") & F.col("url").contains("example")).select("item_id")


@query("flt_recent_published", "SELECT id FROM articles WHERE CAST(published_at AS DATE) BETWEEN CAST(first_seen_at AS DATE) - 1 AND CAST(first_seen_at AS DATE)")
def _flt_recent(spark, sf):
    a = table(spark, sf, "articles")
    seen = F.to_date("first_seen_at")
    return a.filter(F.to_date("published_at").between(F.date_sub(seen, 1), seen)).select("id")


@query("flt_null_tests", "SELECT row_id FROM ceo_articles_modal WHERE llm_label IS NULL AND uncertain IS TRUE AND (llm_severity IS NOT DISTINCT FROM NULL) AND trim(title) <> ''")
def _flt_null(spark, sf):
    m = table(spark, sf, "ceo_articles_modal")
    return m.filter(F.col("llm_label").isNull() & F.col("uncertain").eqNullSafe(True) & F.col("llm_severity").eqNullSafe(None) & (F.trim("title") != "")).select("row_id")


@query("cast_flags", """SELECT row_id, coalesce(lower(trim(controlled)) IN ('true','1','yes','y'), false) AS b,
  CASE WHEN lower(trim(controlled)) IN ('controlled','true','1','yes','y') THEN 'controlled' WHEN lower(trim(controlled)) IN ('uncontrolled','false','0','no','n') THEN 'uncontrolled' END AS c,
  CASE WHEN lower(trim(uncertain_reason)) IN ('true','1','yes','y') THEN true WHEN lower(trim(uncertain_reason)) IN ('false','0','no','n') THEN false END AS o FROM ceo_articles_modal""")
def _cast_flags(spark, sf):
    m = table(spark, sf, "ceo_articles_modal")
    return m.select("row_id", casts.to_bool(F.col("controlled")).alias("b"), casts.to_control(F.col("controlled")).alias("c"), casts.to_optional_bool(F.col("uncertain_reason")).alias("o"))


@query("cast_rank", "SELECT summary_id, CAST(trunc(TRY_CAST(CAST(risk_score AS VARCHAR) AS DOUBLE)) AS INTEGER) AS rank FROM negative_articles_summary")
def _cast_rank(spark, sf):
    return table(spark, sf, "negative_articles_summary").select("summary_id", casts.to_rank(F.col("risk_score").cast("string")).alias("rank"))


@query("cast_datetime")
def _cast_datetime(spark, sf):
    return table(spark, sf, "ceo_articles_modal").select("row_id", casts.to_instant(F.col("published_at")).alias("at"))


@query("cast_llm_fields", "SELECT row_id, coalesce(nullif(trim(llm_label), ''), nullif(trim(llm_severity), '')) AS a, coalesce(nullif(trim(llm_severity), ''), nullif(trim(llm_label), '')) AS b FROM ceo_articles_modal")
def _cast_llm(spark, sf):
    a, b = casts.mirror(F.col("llm_label"), F.col("llm_severity"))
    return table(spark, sf, "ceo_articles_modal").select("row_id", a.alias("a"), b.alias("b"))


_UNITS, _MONTHS = "|".join(casts.UNITS), "|".join(casts.MONTHS)


@query("date_text_test", f"""SELECT item_id, coalesce(regexp_matches(t, '\\b\\d+\\s+({_UNITS})s?\\b') OR regexp_full_match(t, '\\d+\\s*[{casts.UNIT_LETTERS}]') OR regexp_matches(t, '\\b\\d{{4}}-\\d\\d-\\d\\d\\b')
OR regexp_matches(t, '\\b({_MONTHS})[a-z]*\\s+\\d{{1,2}},?\\s+\\d{{4}}\\b'), false) AS is_date FROM (SELECT item_id, lower(published_date) AS t FROM serp_feature_items)""")
def _date_text(spark, sf):
    return table(spark, sf, "serp_feature_items").select("item_id", F.coalesce(casts.looks_like_date(F.col("published_date")), F.lit(False)).alias("is_date"))


@query("date_month_floor", "SELECT item_id, CAST(date_trunc('month', date) AS DATE) AS m, CAST(date_trunc('month', date) - INTERVAL 2 MONTH AS DATE) AS before FROM serp_feature_items")
def _date_month(spark, sf):
    m = casts.month_floor(F.col("date"))
    return table(spark, sf, "serp_feature_items").select("item_id", m.alias("m"), F.add_months(m, -2).alias("before"))


@query("date_local_day", "SELECT id, CAST(timezone('America/New_York', first_seen_at) AS DATE) AS local_day FROM articles")
def _date_local(spark, sf):
    return table(spark, sf, "articles").select("id", F.to_date(F.from_utc_timestamp(F.col("first_seen_at"), "America/New_York")).alias("local_day"))


# --- names and URLs ---------------------------------------------------------

_ING = "trim(regexp_replace(regexp_replace(lower(replace(replace(replace(replace(trim(coalesce({0}, '')), '&', ' and '), '.com', ' '), '.net', ' '), '.org', ' ')), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"
_FORMS = "['inc','incorporated','corp','corporation','co','company','llc','plc','ltd','limited','group','holdings','holding','hldgs','exchange','insurance'{0}]"


def _simple(key: str, extra: str = "") -> str:
    return f"array_to_string(list_filter(string_split({key}, ' '), lambda t: t <> '' AND NOT list_contains({_FORMS.format(extra)}, t)), ' ')"


@query("nm_ingest", f"SELECT id, {_ING.format('name')} AS k, {_simple(_ING.format('name'), chr(44) + chr(39) + 'the' + chr(39))} AS s FROM companies")
def _nm_ingest(spark, sf):
    return table(spark, sf, "companies").select("id", names.ingest_key(F.col("name")).alias("k"), names.ingest_simple(F.col("name")).alias("s"))


LEGAL_TAILS = "(?i)(?: Corporation| Company| Limited| L\\.L\\.C\\.| Corp\\.| Corp| Inc\\.| Inc| Ltd\\.| Ltd| LLC| Co\\.| PLC| plc| Co|\\.com|\\.net|\\.org)$"


@query("nm_feature", f"SELECT id, trim(regexp_replace(lower(trim(regexp_replace(trim(name), '{LEGAL_TAILS}', ''))), '[^a-z0-9\\s]', '', 'g')) AS k FROM companies")
def _nm_feature(spark, sf):
    return table(spark, sf, "companies").select("id", names.feature_key(F.col("name")).alias("k"))


@query("nm_serp", "SELECT id, trim(regexp_replace(regexp_replace(lower(replace(name, '&', ' and ')), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS b, trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) AS c, "
       + _simple("trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))", ",'ag','sa','nv'") + " AS cs FROM companies")
def _nm_serp(spark, sf):
    n = F.col("name")
    return table(spark, sf, "companies").select("id", names.serp_brand_key(n).alias("b"), names.serp_ceo_key(n).alias("c"), names.serp_ceo_simple(n).alias("cs"))


@query("nm_crm", "SELECT id, " + _simple("regexp_replace(replace(lower(name), '&', ' and '), '[^a-z0-9]+', ' ', 'g')") + " AS k FROM companies")
def _nm_crm(spark, sf):
    return table(spark, sf, "companies").select("id", names.crm_key(F.col("name")).alias("k"))


def _cut(tails: list[str], text: str) -> str:
    """SQL that cuts each legal form once from the end of a text, in the order of the list."""
    for tail in tails:
        text = "trim(regexp_replace({}, '{}$', ''))".format(text, tail.replace(".", "\\."))
    return text


_PUNCT = "'[^\\p{L}\\p{N}_\\s]', '', 'g'"


@query("nm_aggregate", f"""SELECT id, CASE WHEN trim(name) = 'nan' THEN '' ELSE trim(regexp_replace(regexp_replace({_cut(names.AGGREGATE_TAILS, 'trim(name)')}, {_PUNCT}), '\\s+', ' ', 'g')) END AS a,
regexp_replace(trim(regexp_replace(trim(name), '(?i){names.alternation(names.ALERT_TAILS)}', '')), {_PUNCT}) AS b FROM companies""")
def _nm_aggregate(spark, sf):
    n = F.col("name")
    return table(spark, sf, "companies").select("id", names.aggregate_key(n).alias("a"), names.alert_key(n).alias("b"))


@query("str_tokens", "SELECT id, list_filter(list_transform(regexp_split_to_array(name, '[^a-zA-Z0-9]+'), lambda t: lower(t)), lambda t: length(t) >= 4 AND NOT list_contains(['inc','incorporated','corporation','corp','company','co','llc','ltd','limited','plc','group','holdings','holding','the','and','of','services'], t)) AS tokens FROM companies")
def _str_tokens(spark, sf):
    return table(spark, sf, "companies").select("id", names.name_tokens(F.col("name")).alias("tokens"))


def _run(text: str) -> str:
    return f"regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


def _forms(least: int, *forms: str) -> str:
    return f"list_sort(list_distinct(list_filter([{', '.join(forms)}], lambda t: t IS NOT NULL AND length(t) >= {least})))"


_FIRST, _LAST = _run("array_to_string(w[1:2], '')"), _run("array_to_string(w[-2:], '')")


@query("str_handles", f"""SELECT id, {_forms(3, _run('name'), f'CASE WHEN len(w) >= 2 THEN {_FIRST} END', f'CASE WHEN len(w) >= 2 THEN {_LAST} END', _run('w[1]'), _run('w[-1]'))} AS person,
{_forms(4, _run('name'), _FIRST)} AS company FROM (SELECT id, name, list_filter(regexp_split_to_array(name, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '') AS w FROM ceos)""")
def _str_handles(spark, sf):
    n = F.col("name")
    return table(spark, sf, "ceos").select("id", names.handle_tokens(n, person=True).alias("person"), names.handle_tokens(n).alias("company"))


@query("str_alias", "SELECT id, list_filter(list_transform(regexp_split_to_array(coalesce(alias, ''), '[|;]+'), lambda a: trim(a)), lambda a: a <> '') AS aliases FROM ceos")
def _str_alias(spark, sf):
    return table(spark, sf, "ceos").select("id", names.split_alias(F.col("alias")).alias("aliases"))


@query("str_truncate", "SELECT id, CASE WHEN length(title) > 60 THEN left(title, 57) || '...' ELSE title END AS t, length(coalesce(title, '')) AS n, len(list_filter(regexp_split_to_array(trim(title), '\\s+'), lambda w: w <> '')) AS w FROM articles")
def _str_cut(spark, sf):
    words = F.size(F.filter(F.split(F.trim("title"), r"\s+"), lambda w: w != ""))
    return table(spark, sf, "articles").select("id", names.headline_cut(F.col("title"), 60).alias("t"), F.length(F.coalesce("title", F.lit(""))).cast("bigint").alias("n"), words.cast("bigint").alias("w"))


@query("str_clean", "SELECT item_id, CASE WHEN lower(trim(regexp_replace(coalesce(published_date, ''), '\\s+', ' ', 'g'))) = 'nan' THEN '' ELSE trim(regexp_replace(coalesce(published_date, ''), '\\s+', ' ', 'g')) END AS t FROM serp_feature_items")
def _str_clean(spark, sf):
    return table(spark, sf, "serp_feature_items").select("item_id", names.clean_text(F.col("published_date")).alias("t"))


@query("url_host", "SELECT id, replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), 'www.', '') AS host FROM articles")
def _url_host(spark, sf):
    return table(spark, sf, "articles").select("id", urls.host(F.col("url")).alias("host"))


@query("url_normalize")
def _url_norm(spark, sf):
    return table(spark, sf, "articles").select("id", urls.normalize(F.col("url")).alias("url"), urls.url_hash(F.col("url")).alias("hash"))


@query("url_hash")
def _url_hash(spark, sf):
    return table(spark, sf, "articles").select("id", urls.url_hash(F.col("url")).alias("h"))


@query("url_item_hash", "SELECT item_id, md5(coalesce(nullif(url, ''), feature_type || '|' || coalesce(CAST(position AS VARCHAR), '') || '|' || title)) AS h FROM serp_feature_items")
def _url_item(spark, sf):
    return table(spark, sf, "serp_feature_items").select("item_id", urls.item_hash(F.col("url"), F.col("feature_type"), F.col("position"), F.col("title")).alias("h"))


@query("url_domain_match", "SELECT item_id FROM serp_feature_items s WHERE EXISTS (SELECT 1 FROM news_sources n WHERE n.domain = s.domain OR s.domain LIKE '%.' || n.domain)")
def _url_domain(spark, sf):
    t = table(spark, sf, "serp_feature_items").select("item_id", "domain")
    n = table(spark, sf, "news_sources").select(F.col("domain").alias("d")).distinct()
    # every suffix of a host is a key, so the match below a domain is an equality
    parts = F.split("domain", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return t.select("item_id", F.explode(tails).alias("d")).join(small(n), "d", "left_semi").select("item_id").distinct()


@query("url_company_domains", """SELECT id, list_sort(list_distinct(list_filter(list_transform(list_filter(list_transform(string_split(coalesce(websites, ''), '|'), lambda x: trim(x)), lambda p: p <> '' AND lower(p) <> 'nan'),
lambda p: replace(lower(regexp_extract(CASE WHEN contains(p, '://') THEN p ELSE 'http://' || p END, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), 'www.', '')), lambda h: contains(h, '.')))) AS domains FROM companies""")
def _url_domains(spark, sf):
    return table(spark, sf, "companies").select("id", urls.domains_of(F.col("websites")).alias("domains"))


# --- joins -----------------------------------------------------------------


@query("join_inner_dim", "SELECT d.doc_id, c.name FROM documents d JOIN companies c ON c.id = d.company_id")
def _join_dim(spark, sf):
    c = table(spark, sf, "companies").select(F.col("id").alias("company_id"), "name")
    return table(spark, sf, "documents").select("doc_id", "company_id").join(small(c), "company_id").select("doc_id", "name")


@query("join_multiway", "SELECT c.id, k.sector, count(*) AS n FROM serp_feature_items s JOIN companies k ON k.id = s.entity_id LEFT JOIN ceos c ON c.company_id = k.id GROUP BY 1, 2")
def _join_multi(spark, sf):
    k = table(spark, sf, "companies").select(F.col("id").alias("entity_id"), "sector")
    c = table(spark, sf, "ceos").select("id", F.col("company_id").alias("entity_id"))
    per = table(spark, sf, "serp_feature_items").groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    # counted before the fan-out of the joins
    return per.join(small(k), "entity_id").join(small(c), "entity_id", "left").groupBy("id", "sector").agg(F.sum("n").alias("n"))


@query("join_unique_lookup", "SELECT k, min(id) AS id FROM (SELECT split_part(lower(name), ' ', 1) AS k, id FROM companies) WHERE k <> '' GROUP BY k HAVING count(DISTINCT id) = 1")
def _join_unique(spark, sf):
    c = table(spark, sf, "companies").select(F.split(F.lower("name"), " ")[0].alias("k"), "id")
    return resolve.unique_lookup(c, "k", "id")


@query("join_fallback_chain", f"""
WITH e AS (SELECT name AS k, min(id) AS id FROM companies GROUP BY 1 HAVING count(DISTINCT id) = 1),
n AS (SELECT {_ING.format('name')} AS k, min(id) AS id FROM companies GROUP BY 1 HAVING count(DISTINCT id) = 1 AND {_ING.format('any_value(name)')} <> ''),
s AS (SELECT k, min(id) AS id FROM (SELECT {_simple(_ING.format('name'), ",'the'")} AS k, id FROM companies) WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT id) = 1)
SELECT m.row_id, coalesce(e.id, n.id, s.id) AS id, CASE WHEN e.id IS NOT NULL THEN 'exact' WHEN n.id IS NOT NULL THEN 'key' WHEN s.id IS NOT NULL THEN 'simple' END AS match_type
FROM ceo_articles_modal m LEFT JOIN e ON e.k = m.company LEFT JOIN n ON n.k = {_ING.format('m.company')} LEFT JOIN s ON s.k = {_simple(_ING.format('m.company'), ",'the'")}""")
def _join_chain(spark, sf):
    return _chained(spark, sf, table(spark, sf, "ceo_articles_modal"))


def _chained(spark, sf, typed):
    keys = [("exact", lambda c: c), ("key", names.ingest_key), ("simple", names.ingest_simple)]
    return resolve.fallback_chain(typed.select("row_id", "company"), "company", table(spark, sf, "companies"), "name", "id", keys).select("row_id", "id", "match_type")


_KEYS = "(SELECT DISTINCT trim(regexp_replace(regexp_replace(lower(query), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) AS q FROM raw_serps WHERE query IS NOT NULL)"
_NKEY = "trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def _serp_keys(spark, sf):
    return table(spark, sf, "raw_serps").filter("query is not null").select(names.serp_ceo_key(F.col("query")).alias("q")).distinct()


@query("resolve_contains_longest", f"SELECT q, v FROM (SELECT q, c.id AS v, row_number() OVER (PARTITION BY q ORDER BY length({_NKEY}) DESC, c.id) AS rn FROM {_KEYS} k JOIN companies c ON contains(' ' || q || ' ', ' ' || {_NKEY} || ' ') WHERE q <> '' AND {_NKEY} <> '') WHERE rn = 1")
def _contains(spark, sf):
    ref = table(spark, sf, "companies").select(names.serp_ceo_key(F.col("name")).alias("n"), F.col("id").alias("v"))
    return resolve.contains_longest(_serp_keys(spark, sf), "q", ref, "n", "v")


@query("resolve_suffix_longest", f"SELECT q, v, trim(left(q, length(q) - length(n))) AS rest FROM (SELECT q, c.id AS v, {_NKEY} AS n, row_number() OVER (PARTITION BY q ORDER BY length({_NKEY}) DESC, c.id) AS rn FROM {_KEYS} k JOIN companies c ON suffix(q, {_NKEY}) AND (q = {_NKEY} OR suffix(q, ' ' || {_NKEY}) OR string_split(q, ' ')[-1] = string_split({_NKEY}, ' ')[-1]) WHERE q <> '' AND {_NKEY} <> '') WHERE rn = 1")
def _suffix(spark, sf):
    ref = table(spark, sf, "companies").select(names.serp_ceo_key(F.col("name")).alias("n"), F.col("id").alias("v"))
    return resolve.suffix_longest(_serp_keys(spark, sf), "q", ref, "n", "v")


@query("resolve_token_subset", f"""SELECT q, v, s AS score FROM (SELECT q, c.id AS v, len(list_distinct(string_split({_NKEY}, ' '))) AS s, row_number() OVER (PARTITION BY q ORDER BY len(list_distinct(string_split({_NKEY}, ' '))) DESC, c.id) AS rn
FROM {_KEYS} k JOIN ceos c ON list_has_all(string_split(q, ' '), string_split({_NKEY}, ' ')) WHERE q <> '' AND {_NKEY} <> '') WHERE rn = 1""")
def _subset(spark, sf):
    ref = table(spark, sf, "ceos").select(names.serp_ceo_key(F.col("name")).alias("n"), F.col("id").alias("v"))
    return resolve.token_subset(_serp_keys(spark, sf), "q", ref, "n", "v").withColumn("score", F.col("score").cast("bigint"))


def _agg(name: str) -> str:
    return f"CASE WHEN trim({name}) = 'nan' THEN '' ELSE trim(regexp_replace(regexp_replace({_cut(names.AGGREGATE_TAILS, f'trim({name})')}, {_PUNCT}), '\\s+', ' ', 'g')) END"


@query("resolve_tiers", f"""WITH n AS (SELECT company, lower({_agg('company')}) AS a FROM (SELECT DISTINCT company FROM ceo_articles_modal WHERE company NOT IN ('', 'nan'))),
k AS (SELECT name, id, lower({_agg('name')}) AS b FROM companies),
c AS (SELECT company, id, CASE WHEN company = name THEN 0 WHEN lower(company) = lower(name) THEN 1 WHEN a = b AND a <> '' THEN 2
WHEN length(company) >= 3 AND length(name) >= 3 AND (contains(lower(company), lower(name)) OR contains(lower(name), lower(company))) THEN 3 END AS t FROM n, k)
SELECT company, id, (['exact', 'case-insensitive', 'normalized', 'partial'])[t + 1] AS tier FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY t, id) AS rn FROM c WHERE t IS NOT NULL) WHERE rn = 1""")
def _tiers(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").select("company")
    return resolve.tiers(m, "company", table(spark, sf, "companies"), "name", "id", names.aggregate_key)


def _crm(name: str) -> str:
    forms = ", ".join(f"'{t}'" for t in names.FORM_TOKENS)
    return f"array_to_string(list_filter(string_split(regexp_replace(replace(lower(coalesce({name}, '')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> '' AND NOT list_contains([{forms}], t)), ' ')"


@query("resolve_fuzzy_account", f"""WITH n AS (SELECT DISTINCT {_crm('company')} AS k FROM ceo_articles_modal WHERE company IS NOT NULL), a AS (SELECT DISTINCT {_crm('name')} AS b, id FROM companies),
p AS (SELECT k, b, id, list_distinct(string_split(k, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM n, a WHERE k <> '' AND b <> ''),
o AS (SELECT *, len(list_intersect(x, y)) AS o FROM p),
s AS (SELECT k, id, CAST(CASE WHEN k = b THEN 100 ELSE greatest(floor(100 * (0.65::DOUBLE * o / len(x) + 0.35::DOUBLE * o / len(y)) + 1e-9) - greatest(len(y) - len(x), 0) * 8
+ CASE WHEN starts_with(b, k || ' ') OR starts_with(k, b || ' ') THEN 5 ELSE 0 END - CASE WHEN split_part(k, ' ', 1) <> split_part(b, ' ', 1) THEN 10 ELSE 0 END, 0) END AS INTEGER) AS score FROM o WHERE o > 0),
r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS next FROM s WINDOW w AS (PARTITION BY k ORDER BY score DESC, id))
SELECT k, id, score FROM r WHERE rn = 1 AND score >= 78 AND score - coalesce(next, 0) >= 4""")
def _fuzzy(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").filter("company is not null").select(names.crm_key(F.col("company")).alias("k"))
    acc = table(spark, sf, "companies").select(names.crm_key(F.col("name")).alias("a"), "id")
    return resolve.best_account(m, "k", acc, "a", "id")


@query("resolve_close_names")
def _close(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").join(table(spark, sf, "companies").select(F.col("name").alias("company")), "company", "left_anti")
    return resolve.close_names(m, "company", table(spark, sf, "companies"), "name")


@query("join_semi_anti", "SELECT 'semi' AS kind, count(*) AS n FROM articles a WHERE EXISTS (SELECT 1 FROM news_sources s WHERE s.source = a.publisher) UNION ALL SELECT 'anti', count(*) FROM articles a WHERE NOT EXISTS (SELECT 1 FROM news_sources s WHERE s.source = a.publisher)")
def _semi(spark, sf):
    a, s = table(spark, sf, "articles"), table(spark, sf, "news_sources").select(F.col("source").alias("publisher")).distinct()
    parts = [a.join(small(s), "publisher", how).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, how in (("semi", "left_semi"), ("anti", "left_anti"))]
    return parts[0].unionByName(parts[1])


@query("join_previous_day", """WITH d AS (SELECT entity_name, date, count(*) AS total, count(*) FILTER (WHERE sentiment_label = 'negative') AS neg FROM serp_feature_items GROUP BY 1, 2)
SELECT d.entity_name, d.date, d.total, d.neg, coalesce(p.total, 0) AS prev_total, coalesce(p.neg, 0) AS prev_neg FROM d LEFT JOIN d p ON p.entity_name = d.entity_name AND p.date = d.date - 1""")
def _join_prev(spark, sf):
    d = table(spark, sf, "serp_feature_items").groupBy("entity_name", "date").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("sentiment_label") == "negative").alias("neg"))
    return rollups.previous_day(d, ["entity_name"], "date", ["total", "neg"])


@query("join_ci_name", "SELECT m.row_id, k.id FROM ceo_articles_modal m JOIN companies k ON lower(m.company) = lower(k.name) AND m.company <> k.name")
def _join_ci(spark, sf):
    k = table(spark, sf, "companies").select("id", "name", F.lower("name").alias("low"))
    m = table(spark, sf, "ceo_articles_modal").select("row_id", "company", F.lower("company").alias("low"))
    return m.join(small(k), "low").filter("company != name").select("row_id", "id")


# --- aggregates --------------------------------------------------------------


@query("agg_sentiment_pivot", "SELECT company, count(*) AS total, count(*) FILTER (WHERE controlled = 'controlled') AS controlled, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'neutral') AS neutral, count(*) FILTER (WHERE sentiment = 'negative') AS negative FROM ceo_articles_modal GROUP BY company")
def _agg_pivot(spark, sf):
    return rollups.sentiment_pivot(table(spark, sf, "ceo_articles_modal"), ["company"], "sentiment", F.col("controlled") == "controlled")


@query("agg_brand_daily", "SELECT company, file_date, count(*) AS total, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment IS NULL OR sentiment NOT IN ('positive', 'negative')) AS neutral, count(*) FILTER (WHERE sentiment = 'negative') AS negative, count(*) FILTER (WHERE sentiment = 'negative') / count(*)::DOUBLE AS neg_pct FROM ceo_articles_modal GROUP BY 1, 2")
def _agg_brand(spark, sf):
    return rollups.brand_daily(table(spark, sf, "ceo_articles_modal"), ["company", "file_date"], "sentiment")


@query("agg_roster_daily", """WITH c AS (SELECT ceo, count(*) FILTER (WHERE sentiment='positive') AS positive, count(*) FILTER (WHERE sentiment='neutral') AS neutral, count(*) FILTER (WHERE sentiment='negative') AS negative FROM ceo_articles_modal WHERE sentiment IN ('positive','neutral','negative') GROUP BY 1),
f AS (SELECT DISTINCT r.name AS ceo, coalesce(positive,0) AS positive, coalesce(neutral,0) AS neutral, coalesce(negative,0) AS negative FROM ceos r LEFT JOIN c ON c.ceo = r.name)
SELECT ceo, positive, neutral, negative, positive+neutral+negative AS total, CASE WHEN positive+neutral+negative = 0 THEN 0.0 ELSE round_even(100 * negative / (positive+neutral+negative)::DOUBLE, 1) END AS neg_pct FROM f""")
def _agg_roster(spark, sf):
    return rollups.roster_daily(table(spark, sf, "ceo_articles_modal"), ["ceo"], "sentiment", table(spark, sf, "ceos").select(F.col("name").alias("ceo")))


@query("agg_modal_value", "SELECT ceo, company FROM (SELECT ceo, company, row_number() OVER (PARTITION BY ceo ORDER BY count(*) DESC, company) AS rn FROM ceo_articles_modal WHERE company IS NOT NULL AND company <> '' GROUP BY 1, 2) WHERE rn = 1")
def _agg_modal(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").filter("company is not null and company != ''")
    return m.groupBy("ceo").agg(rollups.modal(F.col("company")).alias("company"))


_RISK = """WITH b AS (SELECT company, article_type, count(negative_count) AS n, quantile_cont(CAST(negative_count AS DOUBLE), 0.97) AS p FROM negative_articles_summary GROUP BY 1, 2)
SELECT s.summary_id, CASE WHEN b.n >= 14 THEN b.p ELSE 15.0 END AS baseline_p97, greatest(s.negative_count - CASE WHEN b.n >= 14 THEN b.p ELSE 15.0 END, 0.0) + 2 * s.serp_neg_uncontrolled AS risk_score
FROM negative_articles_summary s JOIN b ON b.company = s.company AND b.article_type = s.article_type"""


@query("risk_score_p97", _RISK)
def _risk(spark, sf):
    s = table(spark, sf, "negative_articles_summary").select("summary_id", "company", "article_type", "negative_count", "serp_neg_uncontrolled")
    return rollups.risk_scores(s, ["company", "article_type"], "negative_count", "serp_neg_uncontrolled").select("summary_id", "baseline_p97", "risk_score")


@query("srt_topk_risk", f"SELECT summary_id, risk_score FROM ({_RISK}) ORDER BY risk_score DESC, summary_id LIMIT 10")
def _topk_risk(spark, sf):
    return selection.queue(_risk(spark, sf).select("summary_id", "risk_score"), [F.col("risk_score").desc(), F.col("summary_id")], 10)


@query("agg_top_headlines", "SELECT ceo, file_date, string_agg(t, '|' ORDER BY rn) AS top_headlines FROM (SELECT ceo, file_date, CASE WHEN length(title) > 80 THEN left(title, 77) || '...' ELSE title END AS t, row_number() OVER (PARTITION BY ceo, file_date ORDER BY row_id) AS rn FROM ceo_articles_modal WHERE sentiment = 'negative' AND ceo IS NOT NULL) WHERE rn <= 3 GROUP BY 1, 2")
def _agg_heads(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").filter("sentiment = 'negative' and ceo is not null").select("row_id", "ceo", "file_date", "title")
    return rollups.top_texts(m, ["ceo", "file_date"], names.headline_cut(F.col("title")), ["row_id"])


@query("agg_feature_recompute", "SELECT date, entity_type, entity_name, feature_type, min(entity_id) AS entity_id, count(*) AS total_count, count(*) FILTER (WHERE coalesce(control_class, '') <> 'controlled' AND sentiment_label = 'positive') AS positive_count, count(*) FILTER (WHERE coalesce(control_class, '') <> 'controlled' AND sentiment_label = 'neutral') AS neutral_count, count(*) FILTER (WHERE coalesce(control_class, '') <> 'controlled' AND sentiment_label = 'negative') AS negative_count FROM serp_feature_items GROUP BY 1, 2, 3, 4")
def _agg_recompute(spark, sf):
    label = F.when(F.coalesce("control_class", F.lit("")) != "controlled", F.col("sentiment_label"))
    return rollups.recompute_daily(table(spark, sf, "serp_feature_items"), ["date", "entity_type", "entity_name", "feature_type"], label)


@query("agg_unpivot_counts", "SELECT load_id, feature_type, total_count FROM (SELECT load_id, 'positive' AS feature_type, positive AS total_count FROM ceo_articles_daily_counts_chart UNION ALL SELECT load_id, 'neutral', neutral FROM ceo_articles_daily_counts_chart UNION ALL SELECT load_id, 'negative', negative FROM ceo_articles_daily_counts_chart) WHERE total_count > 0")
def _agg_unpivot(spark, sf):
    c = table(spark, sf, "ceo_articles_daily_counts_chart").select("load_id", "positive", "neutral", "negative")
    return rollups.unpivot_counts(c, ["load_id"], ["positive", "neutral", "negative"])


@query("agg_filter_distinct", "SELECT entity_type, count(DISTINCT entity_name) AS entities, count(DISTINCT CASE WHEN sentiment_label = 'negative' THEN entity_name END) AS hit, count(*) FILTER (WHERE finance_routine) AS finance, min(date) AS first, max(date) AS last FROM serp_feature_items GROUP BY 1")
def _agg_distinct(spark, sf):
    t = table(spark, sf, "serp_feature_items")
    return t.groupBy("entity_type").agg(F.count_distinct("entity_name").alias("entities"), F.count_distinct(F.when(F.col("sentiment_label") == "negative", F.col("entity_name"))).alias("hit"), F.count_if("finance_routine").alias("finance"), F.min("date").alias("first"), F.max("date").alias("last"))


@query("agg_has_both_types", "SELECT company FROM negative_articles_summary GROUP BY 1 HAVING count(DISTINCT article_type) > 1")
def _agg_both(spark, sf):
    return table(spark, sf, "negative_articles_summary").groupBy("company").agg(F.count_distinct("article_type").alias("n")).filter("n > 1").select("company")


@query("agg_tag_counts", "SELECT entity_name, tag, count(*) AS n FROM (SELECT entity_name, unnest(narrative_tags) AS tag FROM serp_feature_items) GROUP BY 1, 2")
def _agg_tags(spark, sf):
    tags = table(spark, sf, "serp_feature_items").select("entity_name", F.explode("narrative_tags").alias("tag"))
    return rollups.tag_counts(tags, ["entity_name"], "tag").select("entity_name", F.explode("tag_counts").alias("tag", "n")).withColumn("n", F.col("n").cast("bigint"))


@query("agg_llm_usage", "SELECT count(*) AS total, count(*) FILTER (WHERE finance_routine) AS finance, count(*) FILTER (WHERE uncertain) AS uncertain, least(count(*) FILTER (WHERE uncertain), 200) AS calls, count(*) FILTER (WHERE uncertain AND llm_label IS NULL) AS pending FROM ceo_articles_modal")
def _agg_usage(spark, sf):
    m = table(spark, sf, "ceo_articles_modal")
    u = F.count_if("uncertain")
    return m.agg(F.count(F.lit(1)).alias("total"), F.count_if("finance_routine").alias("finance"), u.alias("uncertain"), F.least(u, F.lit(200).cast("bigint")).alias("calls"), F.count_if(F.col("uncertain") & F.col("llm_label").isNull()).alias("pending"))


@query("agg_query_metrics", "SELECT count(*) AS n_rows, count(DISTINCT nullif(trim(query), '')) AS queries, count(DISTINCT CASE WHEN raw_json IS NOT NULL THEN nullif(trim(query), '') END) AS with_payload FROM raw_serps")
def _agg_metrics(spark, sf):
    return features.query_metrics(table(spark, sf, "raw_serps")).select("n_rows", "queries", "with_payload")


@query("agg_serp_gate", "SELECT entity_name, count(*) FILTER (WHERE sentiment_label = 'negative') AS neg, count(*) FILTER (WHERE sentiment_label = 'negative' AND coalesce(control_class, '') <> 'controlled') AS neg_uncontrolled FROM serp_feature_items WHERE date = DATE '2025-06-02' GROUP BY 1")
def _agg_gate(spark, sf):
    t = table(spark, sf, "serp_feature_items").filter("date = date'2025-06-02'")
    neg = F.col("sentiment_label") == "negative"
    return t.groupBy("entity_name").agg(F.count_if(neg).alias("neg"), F.count_if(neg & (F.coalesce("control_class", F.lit("")) != "controlled")).alias("neg_uncontrolled"))


# --- JSON features -------------------------------------------------------------

_VALID = "(SELECT row_id, raw_json FROM raw_serps WHERE raw_json IS NOT NULL AND json_valid(raw_json))"


@query("ev_feature_counts", f"SELECT row_id, coalesce(CASE WHEN json_type(raw_json, '$.data.organic_results') = 'ARRAY' THEN json_array_length(raw_json, '$.data.organic_results') END, 0) AS organic, coalesce(CASE WHEN json_type(raw_json, '$.data.top_stories') = 'ARRAY' THEN json_array_length(raw_json, '$.data.top_stories') END, 0) AS top_stories_items FROM {_VALID}")
def _ev_counts(spark, sf):
    r = table(spark, sf, "raw_serps").filter(F.get_json_object("raw_json", "$").isNotNull())
    c = features.counts(r, ["row_id"])
    return c.select("row_id", F.col("organic").cast("bigint").alias("organic"), F.col("top_stories_items").cast("bigint").alias("top_stories_items"))


@query("ev_explode_items")
def _ev_items(spark, sf):
    return features.explode_items(table(spark, sf, "raw_serps").select("row_id", "raw_json"), ["row_id"])


@query("ev_feature_sentiment")
def _ev_sentiment(spark, sf):
    items = features.explode_items(table(spark, sf, "raw_serps").select("row_id", "query", "raw_json"), ["row_id", "query"])
    scored = items.withColumn("s", rules.sentiment_of(compound(F.concat_ws(" ", "title", "snippet"))))
    return rollups.sentiment_pivot(scored, ["query", "feature"], "s").filter("total > 0")


# --- windows, series --------------------------------------------------------------


def _days(spark, sf):
    t = table(spark, sf, "serp_feature_items")
    neg = F.col("sentiment_label") == "negative"
    d = t.groupBy("entity_name", "date").agg(F.count(F.lit(1)).alias("total"), F.count_if(neg).alias("neg"), F.count_if(neg & (F.col("feature_type") == "top_stories_items")).alias("stories"), F.count_if(neg & ~F.col("finance_routine")).alias("recent"))
    return rollups.previous_day(d, ["entity_name"], "date", ["total", "neg"])


_STATE = """WITH d AS (SELECT entity_name, date, count(*) AS total, count(*) FILTER (WHERE sentiment_label='negative') AS neg, count(*) FILTER (WHERE sentiment_label='negative' AND feature_type='top_stories_items') AS stories, count(*) FILTER (WHERE sentiment_label='negative' AND NOT finance_routine) AS recent FROM serp_feature_items GROUP BY 1, 2),
p AS (SELECT d.*, coalesce(q.total, 0) AS prev_total, coalesce(q.neg, 0) AS prev_neg FROM d LEFT JOIN d q ON q.entity_name = d.entity_name AND q.date = d.date - 1),
t AS (SELECT *, stories >= 1 AS b1, (total >= 2 AND 20 * (neg * CASE WHEN prev_total > 0 THEN prev_total ELSE 1 END - CASE WHEN prev_total > 0 THEN prev_neg ELSE 0 END * total) >= 4 * total * CASE WHEN prev_total > 0 THEN prev_total ELSE 1 END AND neg - prev_neg >= 1 AND recent >= 1) AS b2, (recent >= 1 AND total > 0 AND 20 * neg >= 10 * total) AS c FROM p),
l AS (SELECT *, c AND coalesce(date - lag(date) OVER w = 1, false) AS linked FROM t WINDOW w AS (PARTITION BY entity_name ORDER BY date)),
r AS (SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY entity_name ORDER BY date) AS run FROM l)
SELECT entity_name, date, b1 AS top_stories, b2 AS newsfeed_delta, bool_or(b1 OR b2) OVER (PARTITION BY entity_name, run ORDER BY date) AS active FROM r"""


@query("win_event_state", _STATE)
def _win_state(spark, sf):
    d = _days(spark, sf)
    c = [F.col(x) for x in ("total", "neg", "prev_total", "prev_neg", "stories", "recent")]
    t = events.triggers(*c, p={"stories": 1, "total": 2, "neg": 1, "recent": 1})
    d = d.withColumns({"top_stories": t["top_stories"], "newsfeed_delta": t["newsfeed_delta"], "hold": t["continued"]})
    out = events.event_state(d, ["entity_name"], "date", F.col("top_stories") | F.col("newsfeed_delta"), F.col("hold"))
    return out.select("entity_name", "date", "top_stories", "newsfeed_delta", "active")


@query("set_dedupe_event", """SELECT item_id FROM (SELECT item_id, row_number() OVER (PARTITION BY entity_name, date, CASE WHEN trim(coalesce(url,'')) <> '' THEN lower(trim(url)) ELSE lower(trim(coalesce(title,'')) || '::' || trim(coalesce(source,''))) END ORDER BY CASE WHEN feature_type = 'top_stories_items' THEN 0 ELSE 1 END, item_id) AS rn FROM serp_feature_items WHERE sentiment_label = 'negative') WHERE rn = 1""")
def _dedupe_event(spark, sf):
    t = table(spark, sf, "serp_feature_items").filter("sentiment_label = 'negative'").withColumn("rank", F.when(F.col("feature_type") == "top_stories_items", 0).otherwise(1))
    return events.dedupe_evidence(t, ["entity_name", "date"], events.evidence_key(F.col("url"), F.col("title"), F.col("source")), ["rank", "item_id"]).select("item_id")


@query("win_latest_per_key", "SELECT entity_name, url_hash, sentiment_label FROM (SELECT entity_name, url_hash, sentiment_label, row_number() OVER (PARTITION BY entity_name, url_hash ORDER BY date DESC NULLS LAST, item_id DESC) AS rn FROM serp_feature_items) WHERE rn = 1")
def _win_latest(spark, sf):
    t = table(spark, sf, "serp_feature_items").select("item_id", "entity_name", "url_hash", "date", "sentiment_label")
    return selection.latest(t, ["entity_name", "url_hash"], [F.col("date").desc_nulls_last(), F.col("item_id").desc()]).select("entity_name", "url_hash", "sentiment_label")


_CHART = "(SELECT edition, ceo, date, arg_max(coalesce(total, 0), load_id) AS total FROM ceo_articles_daily_counts_chart GROUP BY 1, 2, 3)"


@query("ts_snapshot", f"""SELECT e AS entity, date, total, CASE WHEN b1 <> 0 THEN (total - b1) / b1::DOUBLE * 100 END AS change_1, CASE WHEN b7 <> 0 THEN (total - b7) / b7::DOUBLE * 100 END AS change_7 FROM (
SELECT edition || '/' || ceo AS e, date, total, coalesce(lag(total, 1) OVER w, first_value(total) OVER w) AS b1, coalesce(lag(total, 7) OVER w, first_value(total) OVER w) AS b7 FROM {_CHART} WINDOW w AS (PARTITION BY edition, ceo ORDER BY date))""")
def _ts_snapshot(spark, sf):
    c = table(spark, sf, "ceo_articles_daily_counts_chart").select("edition", "ceo", "date", F.coalesce("total", F.lit(0)).alias("total"), "load_id")
    d = merge.dedupe(c, ["edition", "ceo", "date"], "load_id").select(F.concat_ws("/", F.col("edition").cast("string"), "ceo").alias("entity"), "date", "total")
    return series.snapshots(d, "entity", "date", "total")


@query("ts_explode_history", f"SELECT edition, ceo, date, CAST(total AS DOUBLE) AS value FROM {_CHART}")
def _ts_explode(spark, sf):
    c = merge.dedupe(table(spark, sf, "ceo_articles_daily_counts_chart").select("edition", "ceo", "date", F.coalesce("total", F.lit(0)).alias("total"), "load_id"), ["edition", "ceo", "date"], "load_id")
    pts = F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("d"), F.col("total").cast("string").alias("v"))))
    packed = c.groupBy("edition", "ceo").agg(pts.alias("p")).select("edition", "ceo", F.array_join(F.transform("p", lambda x: x["d"]), "|").alias("ds"), F.array_join(F.transform("p", lambda x: x["v"]), "|").alias("vs"))
    return series.explode_history(packed, ["edition", "ceo"], "ds", "vs")


@query("ts_trend_stats", f"SELECT edition, ceo, avg(total) AS mean, max(total) AS most, arg_max(total, date) AS last FROM {_CHART} GROUP BY 1, 2")
def _ts_stats(spark, sf):
    c = merge.dedupe(table(spark, sf, "ceo_articles_daily_counts_chart").select("edition", "ceo", "date", F.coalesce("total", F.lit(0)).alias("total"), "load_id"), ["edition", "ceo", "date"], "load_id")
    return c.groupBy("edition", "ceo").agg(F.avg("total").alias("mean"), F.max("total").alias("most"), F.max_by("total", "date").alias("last"))


@query("ts_batch_split", "SELECT id, CAST(floor((row_number() OVER (ORDER BY id) * 7 - 1) / (count(*) OVER ())) AS INTEGER) + 1 AS batch FROM companies")
def _ts_batch(spark, sf):
    return series.batch_of(table(spark, sf, "companies").select("id"), ["id"], 7)


# --- sorting, sets, selection -------------------------------------------------------


@query("srt_priority_queue", "SELECT row_id FROM ceo_articles_modal WHERE uncertain ORDER BY CASE WHEN sentiment = 'negative' THEN 0 ELSE 1 END, CASE uncertain_reason WHEN 'low_compound' THEN 0 WHEN 'short_title' THEN 1 ELSE 2 END, length(coalesce(title, '')), file_date DESC NULLS LAST, row_id LIMIT 100")
def _srt_queue(spark, sf):
    m = table(spark, sf, "ceo_articles_modal").filter("uncertain").select("row_id", "sentiment", "uncertain_reason", "title", "file_date")
    order = [
        F.when(F.col("sentiment") == "negative", 0).otherwise(1),
        F.when(F.col("uncertain_reason") == "low_compound", 0).when(F.col("uncertain_reason") == "short_title", 1).otherwise(2),
        F.length(F.coalesce("title", F.lit(""))),
        F.col("file_date").desc_nulls_last(),
        F.col("row_id"),
    ]
    return selection.queue(m, order, 100).select("row_id")


@query("srt_recent_dates", "SELECT date, count(*) AS n FROM serp_feature_items GROUP BY 1 ORDER BY date DESC LIMIT 3")
def _srt_dates(spark, sf):
    return selection.queue(table(spark, sf, "serp_feature_items").groupBy("date").agg(F.count(F.lit(1)).alias("n")), [F.col("date").desc()], 3)


@query("srt_topk_counts", "SELECT company, count(*) AS n FROM ceo_articles_modal m WHERE company IS NOT NULL AND NOT EXISTS (SELECT 1 FROM companies c WHERE c.name = m.company) GROUP BY 1 ORDER BY n DESC, company LIMIT 10")
def _srt_top(spark, sf):
    return selection.queue(_snk_unmatched(spark, sf), [F.col("n").desc(), F.col("company")], 10)


@query("set_union_concat", "SELECT 'brand' AS scope, company AS entity, sum(negative_count) AS negative FROM negative_articles_summary WHERE article_type = 'brand' GROUP BY 2 UNION ALL SELECT 'ceo', ceo, sum(negative_count) FROM negative_articles_summary WHERE article_type = 'ceo' GROUP BY 2")
def _set_union(spark, sf):
    s = table(spark, sf, "negative_articles_summary")
    parts = [s.filter(F.col("article_type") == k).groupBy(F.col(c).alias("entity")).agg(F.coalesce(F.sum("negative_count"), F.lit(0)).cast("bigint").alias("negative")).select(F.lit(k).alias("scope"), "entity", "negative") for k, c in (("brand", "company"), ("ceo", "ceo"))]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


ORACLES["set_union_concat"] = ORACLES["set_union_concat"].replace("sum(negative_count)", "CAST(coalesce(sum(negative_count), 0) AS BIGINT)")


@query("set_difference", "SELECT name FROM ceos EXCEPT SELECT ceo FROM ceo_articles_daily_counts_chart")
def _set_diff(spark, sf):
    return table(spark, sf, "ceos").select("name").distinct().join(table(spark, sf, "ceo_articles_daily_counts_chart").select(F.col("ceo").alias("name")).distinct(), "name", "left_anti")


@query("set_dedupe_articles", "SELECT DISTINCT ceo, title, url FROM ceo_articles_modal")
def _set_dedupe(spark, sf):
    return table(spark, sf, "ceo_articles_modal").select("ceo", "title", "url").dropDuplicates()


@query("sel_gates", "SELECT summary_id, CASE WHEN article_type <> 'brand' THEN 'type' WHEN NOT coalesce(negative_count >= 3, false) THEN 'volume' WHEN NOT serp_neg_uncontrolled > 0 THEN 'serp' END AS skip_reason FROM negative_articles_summary")
def _sel_gates(spark, sf):
    s = table(spark, sf, "negative_articles_summary").select("summary_id", "article_type", "negative_count", "serp_neg_uncontrolled")
    return selection.gated(s, [("type", F.col("article_type") == "brand"), ("volume", F.col("negative_count") >= 3), ("serp", F.col("serp_neg_uncontrolled") > 0)]).select("summary_id", "skip_reason")


@query("sel_budget", "SELECT summary_id, rank FROM (SELECT summary_id, CAST(row_number() OVER (PARTITION BY date ORDER BY negative_count DESC NULLS LAST, summary_id) AS INTEGER) AS rank FROM negative_articles_summary) WHERE rank <= 10")
def _sel_budget(spark, sf):
    s = table(spark, sf, "negative_articles_summary").select("summary_id", "date", "negative_count")
    return selection.budgeted(s, ["date"], [F.col("negative_count").desc_nulls_last(), F.col("summary_id")], 10).select("summary_id", "rank")


@query("sel_pause", """WITH h AS (SELECT company || '_' || article_type AS k, max(date) AS at FROM negative_articles_summary WHERE date <= DATE '2025-06-30' GROUP BY 1)
SELECT s.summary_id, coalesce(epoch(TIMESTAMP '2025-07-03 00:00:00') - epoch(CAST(h.at AS TIMESTAMP)) < 168 * 3600, false) AS paused FROM negative_articles_summary s LEFT JOIN h ON h.k = s.company || '_' || s.article_type""")
def _sel_pause(spark, sf):
    s = table(spark, sf, "negative_articles_summary")
    key = F.concat_ws("_", "company", "article_type")
    h = s.filter("date <= date'2025-06-30'").select(key.alias("alert_key"), F.to_timestamp("date").alias("sent_at"))
    now = F.lit("2025-07-03 00:00:00").cast("timestamp")
    return selection.paused(s.select("summary_id", "company", "article_type"), h, key, F.col("company"), now).select("summary_id", "paused")


# --- rules -----------------------------------------------------------------------

_B, _E = r"(?:^|[^\p{L}\p{M}\p{N}_])(?:", r")(?:$|[^\p{L}\p{M}\p{N}_])"


def _has(col: str, words: str) -> str:
    return f"regexp_matches(lower({col}), '{_B}{words}{_E}')"


_HEAD = "concat_ws(' ', nullif(trim(coalesce(title, '')), ''), nullif(trim(coalesce(snippet, '')), ''))"
_SRC = "concat_ws(' ', nullif(trim(coalesce(title, '')), ''), nullif(trim(coalesce(snippet, '')), ''), nullif(trim(coalesce(publisher, '')), ''))"
_ALL = "concat_ws(' ', nullif(trim(coalesce(title, '')), ''), nullif(trim(coalesce(snippet, '')), ''), nullif(trim(coalesce(publisher, '')), ''), nullif(trim(coalesce(url, '')), ''))"
_FLAGS = f"""SELECT id, {_has(_SRC, 'shares|outlook|report|stock|analysts|debt')} AS finance, {_has(_HEAD, 'court|fines|inquiry|leak|injured')} AS material,
{_has(_HEAD, 'jobs|staff|walk\\s+out')} AND NOT {_has(_HEAD, 'injured|court')} AS low, {_has(_ALL, 'court|claim|regulator|inquiry')} AS law FROM articles"""


def _flagged(articles):
    return rules.flags(articles.select("id", "title", "snippet", "publisher", "url"), "title", "snippet", "publisher", "url")


def _flag_columns(articles):
    return _flagged(articles).select("id", F.col("r_finance").alias("finance"), F.col("r_material").alias("material"), F.col("r_low").alias("low"), F.col("r_legal").alias("legal"))


@query("rule_flags", f"SELECT id, finance, material, low, NOT low AND law AS legal FROM ({_FLAGS})")
def _rule_flags(spark, sf):
    return _flag_columns(table(spark, sf, "articles"))


@query("rule_neutralised", f"SELECT id, low OR (finance AND NOT material) AS neutral FROM ({_FLAGS})")
def _rule_neutral(spark, sf):
    return _flagged(table(spark, sf, "articles")).select("id", rules.neutralised(F.lit("negative")).alias("neutral"))


@query("rule_sentiment_cascade")
def _rule_cascade(spark, sf):
    f = _flagged(table(spark, sf, "articles")).withColumn("c", compound(F.col("title")))
    reddit = F.lower(F.coalesce("publisher", F.lit(""))).contains("reddit")
    label = rules.cascade(F.col("c"), F.lit(False), reddit)
    why = rules.uncertain_reason(F.col("label"), F.col("c"), F.col("title"), F.col("r_finance"), F.col("r_legal"))
    return f.withColumn("label", label).select("id", "label", why.alias("reason"))


@query("rule_control")
def _rule_control(spark, sf):
    companies = table(spark, sf, "companies")
    k = companies.select(F.col("id").alias("company_id"), F.col("name").alias("company"), urls.domains_of(F.col("websites")).alias("domains"))
    # an item without an id is of the company of its name, or of the one company that its person leads
    named = resolve.unique_lookup(companies.select(F.col("name").alias("entity_name"), F.col("id").alias("named")), "entity_name", "named")
    led = resolve.unique_lookup(table(spark, sf, "ceos").select(F.col("name").alias("entity_name"), F.col("company_id").alias("led")), "entity_name", "led")
    s = table(spark, sf, "serp_feature_items").select("item_id", "entity_id", "entity_name", "source", "url", "title")
    s = s.join(small(named), "entity_name", "left").join(small(led), "entity_name", "left").withColumn("company_id", F.coalesce("entity_id", "named", "led"))
    j = s.join(small(k), "company_id", "left").withColumn("company", F.coalesce("company", "entity_name"))
    return j.select("item_id", rules.control_class(F.col("company"), F.col("source"), F.col("url"), F.col("title"), F.col("domains")).alias("control"))


@query("rule_uncertain", """SELECT row_id, CASE WHEN NOT finance_routine AND sentiment IN ('negative','neutral') THEN CASE WHEN len(list_filter(regexp_split_to_array(trim(title), '\\s+'), lambda w: w <> '')) <= 6 THEN 'short_title' END END AS reason FROM ceo_articles_modal""")
def _rule_uncertain(spark, sf):
    m = table(spark, sf, "ceo_articles_modal")
    return m.select("row_id", rules.uncertain_reason(F.col("sentiment"), F.lit(None).cast("double"), F.col("title"), F.col("finance_routine"), F.lit(False)).alias("reason"))


@query("vader_score")
def _vader(spark, sf):
    return table(spark, sf, "articles").select("id", compound(F.col("title")).alias("compound"))


def _narratives(articles):
    n = rules.narrative(rules.haystack(F.col("title"), F.col("snippet")), rules.DEFAULT, ("safety", "governance", "labour"), ("deals", "growth"))
    return articles.select("id", n.alias("n")).select("id", F.col("n.primary_tag").alias("tag"), F.col("n.primary_group").alias("grp"))


_NAR = f"CASE WHEN {_has(_HEAD, 'injured|recalls|leak')} THEN 'safety' WHEN {_has(_HEAD, 'inquiry|named|boss|chief')} THEN 'governance' WHEN {_has(_HEAD, 'jobs|staff|walk')} THEN 'labour' WHEN {_has(_HEAD, 'deal|venture|programme')} THEN 'deals' WHEN {_has(_HEAD, 'opens|expands|lifts')} THEN 'growth' END"


@query("nar_classify", f"SELECT id, {_NAR} AS tag, CASE WHEN {_NAR} IN ('safety','governance','labour') THEN 'crisis' WHEN {_NAR} IS NOT NULL THEN 'non_crisis' END AS grp FROM articles")
def _nar(spark, sf):
    return _narratives(table(spark, sf, "articles"))


@query("nar_rollup_day", """WITH c AS (SELECT entity_name, date, narrative_primary_tag AS tag FROM serp_feature_items WHERE sentiment_label = 'negative' AND NOT finance_routine),
p AS (SELECT entity_name, date, tag, count(*) AS n FROM c GROUP BY 1, 2, 3),
t AS (SELECT entity_name, date, CAST(sum(n) AS BIGINT) AS candidates, max(CASE WHEN tag IS NOT NULL THEN n END) AS most, sum(CASE WHEN tag IS NULL THEN n ELSE 0 END) AS untagged FROM p GROUP BY 1, 2),
f AS (SELECT p.entity_name, p.date, min(p.tag) AS tag FROM p JOIN t ON t.entity_name = p.entity_name AND t.date = p.date WHERE p.tag IS NOT NULL AND p.n = t.most GROUP BY 1, 2)
SELECT t.entity_name, t.date, t.candidates, t.candidates >= 2 AS passed, CASE WHEN t.candidates >= 2 THEN coalesce(f.tag, CASE WHEN untagged >= 2 THEN 'Other' END) END AS primary_tag FROM t LEFT JOIN f ON f.entity_name = t.entity_name AND f.date = t.date""")
def _nar_day(spark, sf):
    t = table(spark, sf, "serp_feature_items")
    c = t.select("entity_name", "date", F.col("narrative_primary_tag").alias("tag"), ((F.col("sentiment_label") == "negative") & ~F.col("finance_routine")).alias("candidate"))
    return rules.narrative_day(c, ["entity_name", "date"])


# --- entity merges -----------------------------------------------------------------

#: Two companies of the first word that several share: the later one is merged into the earlier.
_MOVE = """(SELECT max(name) AS old, min(name) AS new FROM companies WHERE split_part(name, ' ', 1) =
(SELECT min(w) FROM (SELECT split_part(name, ' ', 1) AS w FROM companies GROUP BY 1 HAVING count(*) > 1)))"""


def _moves(spark, sf):
    k = table(spark, sf, "companies").select("name", F.split("name", " ")[0].alias("w"))
    pair = k.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("old"), F.min("name").alias("new")).filter("n > 1")
    return pair.agg(F.min_by(F.struct("old", "new"), "w").alias("p")).select("p.old", "p.new")


@query("mrg_rekey", f"""SELECT company, article_type, date, edition, summary_id FROM (SELECT coalesce(CASE WHEN s.company = m.old THEN m.new END, s.company) AS company, article_type, date, edition, summary_id,
row_number() OVER (PARTITION BY coalesce(CASE WHEN s.company = m.old THEN m.new END, s.company), article_type, date, edition ORDER BY CASE WHEN s.company = m.old THEN 1 ELSE 0 END, summary_id) AS rn FROM negative_articles_summary s CROSS JOIN {_MOVE} m) WHERE rn = 1""")
def _rekey(spark, sf):
    s = table(spark, sf, "negative_articles_summary").select("company", "article_type", "date", "edition", "summary_id")
    return merge.rekey(s, "company", small(_moves(spark, sf)), ["company", "article_type", "date", "edition"], ["summary_id"])


@query("mrg_preview", f"""SELECT count(*) FILTER (WHERE company = m.old) AS source_rows, count(*) FILTER (WHERE company = m.new) AS target_rows,
count(*) FILTER (WHERE company = m.old AND EXISTS (SELECT 1 FROM negative_articles_summary t WHERE t.company = m.new AND t.date = s.date AND t.article_type = s.article_type AND t.edition = s.edition)) AS shared FROM negative_articles_summary s CROSS JOIN {_MOVE} m""")
def _preview(spark, sf):
    s = table(spark, sf, "negative_articles_summary")
    m = _moves(spark, sf).first()
    return maintain.overlap(s, "company", F.lit(m.old), F.lit(m.new), ["date", "article_type", "edition"])


@query("mrg_metadata", """WITH g AS (SELECT split_part(name, ' ', 1) AS w, min(id) AS target FROM companies GROUP BY 1 HAVING count(*) > 1)
SELECT t.id AS target, s.id AS source, coalesce(nullif(t.sector, ''), nullif(s.sector, '')) AS sector, t.favorite OR s.favorite AS favorite
FROM g JOIN companies t ON t.id = g.target JOIN companies s ON split_part(s.name, ' ', 1) = g.w AND s.id <> t.id""")
def _metadata(spark, sf):
    k = table(spark, sf, "companies").withColumn("w", F.split("name", " ")[0])
    g = k.groupBy("w").agg(F.min_by(F.struct("id", "sector", "favorite"), "id").alias("t"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    j = k.join(small(g), "w").filter("id != t.id")
    return j.select(F.col("t.id").alias("target"), F.col("id").alias("source"), maintain.filled(F.col("t.sector"), F.col("sector")).alias("sector"), (F.col("t.favorite") | F.col("favorite")).alias("favorite"))


@query("mrg_coverage", "SELECT 'items' AS table_name, count(*) AS n, min(date) AS first, max(date) AS last FROM serp_feature_items UNION ALL SELECT 'summary', count(*), min(date), max(date) FROM negative_articles_summary")
def _coverage(spark, sf):
    return maintain.coverage({"items": (table(spark, sf, "serp_feature_items"), "date"), "summary": (table(spark, sf, "negative_articles_summary"), "date")})


@query("mrg_rollup_distinct", """SELECT c.id, coalesce(d.n, 0) AS daily_rows, coalesce(m.n, 0) AS articles FROM ceos c LEFT JOIN (SELECT ceo, count(DISTINCT date) AS n FROM ceo_articles_daily_counts_chart GROUP BY 1) d ON d.ceo = c.name LEFT JOIN (SELECT ceo, count(DISTINCT url) AS n FROM ceo_articles_modal GROUP BY 1) m ON m.ceo = c.name""")
def _rollup_distinct(spark, sf):
    # each side is aggregated before the joins, which would multiply its rows
    d = table(spark, sf, "ceo_articles_daily_counts_chart").groupBy(F.col("ceo").alias("name")).agg(F.count_distinct("date").alias("daily_rows"))
    m = table(spark, sf, "ceo_articles_modal").groupBy(F.col("ceo").alias("name")).agg(F.count_distinct("url").alias("articles"))
    return table(spark, sf, "ceos").select("id", "name").join(d, "name", "left").join(m, "name", "left").fillna(0, ["daily_rows", "articles"]).select("id", "daily_rows", "articles")
