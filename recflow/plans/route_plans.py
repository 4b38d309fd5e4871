"""Registered plans for routing (L2) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from recflow.fixtures import duckdb_with
from recflow.functions import vocab
from recflow.operators import route
from recflow.operators.sinks import write_partitioned
from recflow.plans.common import RUN_TS, fx
from recflow.plans.oracle_sql import blocked_case, category_case, sq, words_re
from recflow.plans import oracle_headers as oh
from recflow.sources.documents import parse_documents

QUERIES: dict = {}
ORACLES: dict = {}


def _classified(spark, sf):
    return route.classify_title(fx(spark, sf).recordings)


def q_classify_title(spark, sf):
    return _classified(spark, sf).select("doc_id", "title", "category", "sync_blocked")


QUERIES["classify_title"] = q_classify_title
ORACLES["classify_title"] = duckdb_with(["recordings"]) + f"""
SELECT doc_id, title, category, {blocked_case('category')} AS sync_blocked
FROM (SELECT doc_id, title, {category_case('title')} AS category FROM recordings)
"""


def q_route_counts(spark, sf):
    return route.route_counts(_classified(spark, sf))


QUERIES["route_counts"] = q_route_counts
ORACLES["route_counts"] = duckdb_with(["recordings"]) + f"""
SELECT category, count(*) AS n_docs
FROM (SELECT {category_case('title')} AS category FROM recordings) GROUP BY category
"""


def q_sync_flag(spark, sf):
    return (_classified(spark, sf).groupBy("category", "sync_blocked")
            .agg(F.count(F.lit(1)).alias("n_docs")))


QUERIES["sync_flag"] = q_sync_flag
ORACLES["sync_flag"] = duckdb_with(["recordings"]) + f"""
SELECT category, {blocked_case('category')} AS sync_blocked, count(*) AS n_docs
FROM (SELECT {category_case('title')} AS category FROM recordings) GROUP BY category
"""


def q_rule_hits(spark, sf):
    return route.rule_hits(fx(spark, sf).recordings)


_kw_selects = "\nUNION ALL ".join(
    f"SELECT {sq(c)} AS category, {sq(w)} AS keyword, count(*) AS n_titles FROM recordings "
    f"WHERE regexp_matches(coalesce(title, ''), {sq(words_re([w]))}) HAVING count(*) > 0"
    for c, _b, ws in vocab.ROUTING_RULES for w in ws)
QUERIES["rule_hits"] = q_rule_hits
ORACLES["rule_hits"] = duckdb_with(["recordings"]) + _kw_selects + "\n"


def _parsed_headers(spark, sf):
    return parse_documents(fx(spark, sf).headers)


def q_patch_routed(spark, sf):
    df = route.classify_title(_parsed_headers(spark, sf))
    return route.patch_routed(df, RUN_TS).select(
        "doc_id", "has_header", "status", "routed_category", "routed_sync_blocked", "routed_at")


QUERIES["patch_routed"] = q_patch_routed
ORACLES["patch_routed"] = duckdb_with(["headers"]) + f"""
SELECT doc_id, has_header,
  CASE WHEN has_header AND status IS NOT NULL THEN 'routed' ELSE status END AS status,
  CASE WHEN has_header THEN category END AS routed_category,
  CASE WHEN has_header THEN {blocked_case('category')} END AS routed_sync_blocked,
  CASE WHEN has_header THEN {sq(RUN_TS)} END AS routed_at
FROM (SELECT doc_id, {oh.has_header('text')} AS has_header,
        {oh.header_get('text', 'ingestion_status')} AS status,
        {category_case(oh.header_title('text', 'stem'))} AS category
      FROM headers)
"""


def _routed_table(spark, sf):
    """Route, then write partitioned by category into a fresh shared folder."""
    df = _classified(spark, sf).select("stem", "title", "sync_blocked", "category")
    path = write_partitioned(spark, df, "routed", "category")
    return spark.read.parquet(path)


def q_route_write(spark, sf):
    return _routed_table(spark, sf).select("stem", "title", "category", "sync_blocked")


QUERIES["route_write"] = q_route_write
ORACLES["route_write"] = duckdb_with(["recordings"]) + f"""
SELECT stem, title, category, {blocked_case('category')} AS sync_blocked
FROM (SELECT stem, title, {category_case('title')} AS category FROM recordings)
"""


def q_unclassified_only(spark, sf):
    t = _routed_table(spark, sf)
    return t.where(F.col("category") == vocab.FALLBACK_CATEGORY).select("stem", "title")


QUERIES["unclassified_only"] = q_unclassified_only
ORACLES["unclassified_only"] = duckdb_with(["recordings"]) + f"""
SELECT stem, title FROM recordings WHERE {category_case('title')} = {sq(vocab.FALLBACK_CATEGORY)}
"""


def q_bucket_union(spark, sf):
    """The five buckets, out of a tree that also holds a staging folder and another bucket."""
    t = _classified(spark, sf).withColumn("category", F.when(F.col("doc_id") % 25 == 0, "Finance")
                                          .when(F.col("doc_id") % 25 == 1, "_raw").otherwise(F.col("category")))
    return t.where(F.col("category").isin(vocab.BUCKETS)).select("stem", "category")


QUERIES["bucket_union"] = q_bucket_union
ORACLES["bucket_union"] = duckdb_with(["recordings"]) + f"""
SELECT stem, category FROM (SELECT stem, CASE doc_id % 25 WHEN 0 THEN 'Finance' WHEN 1 THEN '_raw'
  ELSE {category_case('title')} END AS category FROM recordings)
WHERE category IN ({', '.join(sq(b) for b in vocab.BUCKETS)})
"""


def q_route_order(spark, sf):
    return _classified(spark, sf).select("stem", "category").orderBy("stem")


QUERIES["route_order"] = q_route_order
ORACLES["route_order"] = duckdb_with(["recordings"]) + f"""
SELECT stem, {category_case('title')} AS category FROM recordings ORDER BY stem
"""
