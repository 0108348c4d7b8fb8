"""Queries of the operators for language-model data (problems 4, 6, 7, 8, 9 and 10) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.dedupe import find_repeats
from tidemark.llm.leakage import leaks
from tidemark.llm.mixing import count_tokens, reached, replicate, source_plan
from tidemark.llm.quality import flags, statistics
from tidemark.llm.quantiles import percentiles, value_counts
from tidemark.llm.resolve import Habits, hosts_of, resolve_values
from tidemark.operators.packed import ADDRESS_DELIMITERS, unpack
from tidemark.session import durable, small, table


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    modal = table(spark, sf, "ceo_articles_modal").select(F.lit("ceo_articles_modal").alias("table_name"), "row_id", F.col("company").alias("value"))
    serps = table(spark, sf, "raw_serps").select(F.lit("raw_serps").alias("table_name"), "row_id", F.col("query").alias("value"))
    return modal.unionByName(serps)


#: How the companies' web names are written.
HABITS = Habits(("group", "news", "shop", "careers", "press", "media", "store", "corp"), ("example", "test", "com", "net", "org"), 3)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The entry meant by every typed name that is not exactly one."""
    companies = table(spark, sf, "companies")
    sites = unpack(companies, "id", "websites", ADDRESS_DELIMITERS).select(F.col("row_key").alias("id"), F.explode_outer(hosts_of(F.col("val"))).alias("host"))
    hosts = sites.groupBy("id").agg(F.collect_set("host").alias("hosts"))
    entries = durable(companies.select("id", "name", "ticker").join(hosts, "id", "left"))
    exact = entries.select(F.col("name").alias("value")).distinct()
    odd = _typed(spark, sf).filter("value is not null").join(small(exact), "value", "left_anti")
    odd = odd.filter(F.regexp_replace("value", r"[\s\p{Z}\p{Cf}]+", "") != "")
    people = table(spark, sf, "ceos").select("name")
    answers = resolve_values(odd, entries, people, HABITS)
    return odd.join(answers, "value").select("table_name", "row_id", F.col("entry").alias("company_id"))


def p6_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Median and high percentiles of negative counts by company and article type, from the counts of each day's rows."""
    counts = value_counts(table(spark, sf, "negative_articles_summary"), ["company", "article_type"], "negative_count")
    return percentiles(counts, ["company", "article_type"], {"p50": 0.5, "p90": 0.9, "p97": 0.97, "p99": 0.99})


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Groups whose 97th percentile is at least seven times their median."""
    ids = table(spark, sf, "companies").select(F.col("id").alias("company_id"), F.col("name").alias("company"))
    wide = p6_quantiles(spark, sf).filter((F.col("n") >= 14) & (F.col("p97") >= 7 * F.col("p50")))
    return wide.join(small(ids), "company").select("company_id", "article_type")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of later batches that repeat an earlier one; later batches meet a stored pivot table, each what was accepted up to it."""
    sources = table(spark, sf, "news_sources").select("source")
    found = find_repeats(table(spark, sf, "articles"), order=("batch_no", "id"), batch="batch_no", sources=sources)
    return found.filter("turn.o0 >= 1").select("id_a", "id_b")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a passage of a test item."""
    return leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items").select("item_id", "text"))


#: The vocabulary in which sizes are counted; its content is sent to the executors.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _sizes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their tokens, counted once, and the mixing plan."""
    docs = durable(count_tokens(table(spark, sf, "documents").select("doc_id", "source", "text"), VOCABULARY, keep=["doc_id", "source"]))
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    return docs, durable(source_plan(sizes, table(spark, sf, "mix_targets")))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target shares and the shares reached by the replicated documents."""
    docs, plan = _sizes(spark, sf)
    return reached(docs, plan, "doc_id")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Sources whose replicated documents, each used as often as allowed, hold less than their share."""
    return p9_shares(spark, sf).filter("short").select("source")


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The mixture itself: every copy of every document, globally shuffled."""
    sized, plan = _sizes(spark, sf)
    return replicate(table(spark, sf, "documents").select("doc_id", "source", "text"), sized, plan, "doc_id")


def p10_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of every document with their robust z-scores."""
    # Read twice, by the sketches and by the scores: small numbers, kept instead of the texts.
    return flags(durable(statistics(table(spark, sf, "documents"))))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that are for the most part not natural prose."""
    return p10_statistics(spark, sf).filter("junk").select("doc_id")


QUERIES = {
    "p4_found": p4_found,
    "p6_found": p6_found,
    "p6_quantiles": p6_quantiles,
    "p7_found": p7_found,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_shares": p9_shares,
    "p9_mix": p9_mix,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}

_P6 = """
  SELECT company, article_type, count(*) AS n,
    quantile_cont(CAST(negative_count AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(negative_count AS DOUBLE), 0.9) AS p90,
    quantile_cont(CAST(negative_count AS DOUBLE), 0.97) AS p97, quantile_cont(CAST(negative_count AS DOUBLE), 0.99) AS p99
  FROM negative_articles_summary WHERE negative_count IS NOT NULL GROUP BY company, article_type
"""
#: Words stand for tokens: any common way of counting names the same sources.
_P9 = """
  WITH sizes AS (
    SELECT source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\\s]+'))) AS tokens FROM documents GROUP BY source
  ), total AS (SELECT sum(tokens) AS tokens FROM sizes)
  SELECT t.source FROM mix_targets t LEFT JOIN sizes s ON s.source = t.source, total
  WHERE coalesce(s.tokens, 0) * t.max_repeats < t.target_share * total.tokens
"""
#: Folding as in the operator: accents and the invisible characters met in feeds do not count.
_P8 = r"""
  WITH folded AS (
    SELECT kind, id, list_filter(regexp_split_to_array(
        regexp_replace(replace(strip_accents(lower(nfc_normalize(t))), 'ß', 'ss'), '[\p{M}\p{Cf}]+', '', 'g'), '[^\p{L}\p{N}]+'), lambda x: x != '') AS w
    FROM (SELECT 0 AS kind, doc_id AS id, text AS t FROM documents UNION ALL SELECT 1, item_id, text FROM eval_items) u WHERE t IS NOT NULL
  ), spans AS (
    SELECT kind, id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(list_slice(w, i, i + 12), ' '))) AS span FROM folded WHERE len(w) >= 13
  )
  SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM spans d JOIN spans i ON d.span = i.span AND d.kind = 0 AND i.kind = 1
"""
ORACLES = {
    "p8_found": _P8,
    "p9_found": _P9,
    "p6_quantiles": _P6,
    "p6_found": f"""SELECT c.id AS company_id, q.article_type FROM ({_P6}) q JOIN companies c ON c.name = q.company
                    WHERE q.n >= 14 AND q.p97 >= 7 * q.p50""",
}
