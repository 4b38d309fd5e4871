"""Registered plans for model reclassification and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from recflow.functions import projections as P
from recflow.functions import vocab
from recflow.operators import reclassify as R
from recflow.plans.common import MODEL_NAME, RECLASS_TS, fx
from recflow.plans.enrich_plans import E_CTES, E_VIEWS, edocs, esummaries
from recflow.fixtures import duckdb_with
from recflow.plans.oracle_sql import DWS, py_strip, sq

QUERIES: dict = {}
ORACLES: dict = {}

# ---------------------------------------------------------------- Spark side


def _unclassified(spark, sf):
    d = edocs(spark, sf).withColumn("sync_blocked", P.sync_flag("category"))
    d = R.reclass_batch(d, max_docs=None)
    return d.join(esummaries(spark, sf).select("doc_id", "summary"), "doc_id", "left")


def _replies(spark, sf):
    r = fx(spark, sf).replies.select(F.col("stem").alias("doc_key"), "raw", "cache_read", "cache_create")
    return r.join(_unclassified(spark, sf).select("doc_key"), "doc_key", "left_semi")


def _decoded(spark, sf):
    return R.verdict_decode(_replies(spark, sf))


# ---------------------------------------------------------------- oracle side

_FENCE = r"(?m)^```(?:json)?" + DWS + r"*|" + DWS + r"*```$"
PROMPT_SQL = ("'Title: ' || title || chr(10) || chr(10) || 'Summary excerpt:' || chr(10) || "
           f"coalesce(nullif(summary, ''), "
           f"{sq(vocab.NO_SUMMARY_PLACEHOLDER)})")
_FIRST_NAMED = "CASE " + " ".join(f"WHEN contains(clean, {sq(c)}) THEN {sq(c)}" for c in vocab.VALID_CATEGORIES) + " END"

R_CTES = f""",
unc AS (SELECT e.doc_key, e.doc_id, e.title, e.category, s.summary FROM edocs e
        LEFT JOIN summaries s ON s.doc_id = e.doc_id WHERE e.category = {sq(vocab.FALLBACK_CATEGORY)}),
rep AS (SELECT r.stem AS doc_key, r.raw, r.cache_read, r.cache_create,
          {py_strip(f"regexp_replace({py_strip('r.raw')}, {sq(_FENCE)}, '', 'g')")} AS clean
        FROM replies r WHERE r.stem IN (SELECT doc_key FROM unc)),
rep1 AS (SELECT *, '[' || clean || ']' AS w,
           CASE WHEN clean <> '' AND coalesce(json_valid('[' || clean || ']'), false)
                THEN json_array_length('[' || clean || ']') = 1 ELSE false END AS strict FROM rep),
rep2 AS (SELECT *, CASE WHEN strict THEN json_type(w, '$[0]') END AS t0,
           CASE WHEN strict THEN json_type(w, '$[0].category') END AS tc,
           CASE WHEN strict THEN json_type(w, '$[0].confidence') END AS tf,
           CASE WHEN strict THEN json_type(w, '$[0].reason') END AS tr, {_FIRST_NAMED} AS named
         FROM rep1),
rep3 AS (SELECT *,
           CASE WHEN tf IS NULL THEN 0.0
                WHEN tf = 'BOOLEAN' THEN CASE WHEN json_extract_string(w, '$[0].confidence') = 'true' THEN 1.0 ELSE 0.0 END
                WHEN tf = 'VARCHAR' THEN CASE WHEN regexp_matches({py_strip("json_extract_string(w, '$[0].confidence')")}, {sq(R.FLOAT_TEXT)})
                  THEN TRY_CAST(replace({py_strip("json_extract_string(w, '$[0].confidence')")}, '_', '') AS DOUBLE) END
                WHEN tf IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(json_extract_string(w, '$[0].confidence') AS DOUBLE)
           END AS conf_num,
           CASE WHEN tr IS NULL THEN '' WHEN tr = 'VARCHAR' THEN json_extract_string(w, '$[0].reason')
                WHEN tr = 'NULL' THEN 'None' ELSE json_extract(w, '$[0].reason')::VARCHAR END AS reason_txt
         FROM rep2),
rep4 AS (SELECT *, CASE WHEN strict THEN
           CASE WHEN t0 IS DISTINCT FROM 'OBJECT' THEN 'not an object' WHEN tc IS NULL THEN 'no category'
                WHEN tc <> 'VARCHAR' THEN 'category not text' WHEN conf_num IS NULL THEN 'confidence not numeric' END
           END AS error FROM rep3),
dec AS (SELECT doc_key, cache_read, cache_create, clean, error,
          CASE WHEN strict THEN 1 WHEN named IS NOT NULL THEN 2 ELSE 3 END AS tier,
          CASE WHEN strict THEN json_extract_string(w, '$[0].category') WHEN named IS NOT NULL THEN named
               ELSE {sq(vocab.UNPARSEABLE_CATEGORY)} END AS category,
          CASE WHEN strict THEN conf_num WHEN named IS NOT NULL THEN {vocab.PARSE_FALLBACK_CONFIDENCE} ELSE 0.0 END AS confidence,
          CASE WHEN strict THEN reason_txt WHEN named IS NOT NULL THEN {sq(vocab.PARSE_FALLBACK_REASON)}
               ELSE {sq(vocab.UNPARSEABLE_PREFIX)} || clean END AS reason
        FROM rep4),
ok AS (SELECT * FROM dec WHERE error IS NULL)
"""


def rq(select: str) -> str:
    return duckdb_with(E_VIEWS + ["replies"]).rstrip("\n") + "," + E_CTES.rstrip("\n") + R_CTES + select


# ---------------------------------------------------------------- plans


def q_reclass_batch(spark, sf):
    d = edocs(spark, sf)
    return R.reclass_batch(d).select("doc_key", "title")


QUERIES["reclass_batch"] = q_reclass_batch
ORACLES["reclass_batch"] = rq("SELECT doc_key, title FROM unc\n")

QUERIES["prompt_text"] = lambda spark, sf: R.with_prompt(_unclassified(spark, sf)).select("doc_key", "prompt")
ORACLES["prompt_text"] = rq(f"SELECT doc_key, {PROMPT_SQL} AS prompt FROM unc\n")

QUERIES["fence_strip"] = lambda spark, sf: _replies(spark, sf).select("doc_key", P.fence_strip("raw").alias("clean"))
ORACLES["fence_strip"] = rq("SELECT doc_key, clean FROM rep\n")

QUERIES["verdict_decode"] = lambda spark, sf: R.verdicts_ok(_decoded(spark, sf)).select(
    "doc_key", "tier", "category", "confidence", "reason", "valid_category")
ORACLES["verdict_decode"] = rq(
    f"SELECT doc_key, tier, category, confidence, reason, category IN "
    f"({', '.join(sq(c) for c in vocab.VALID_CATEGORIES)}) AS valid_category FROM ok\n")

QUERIES["verdict_errors"] = lambda spark, sf: R.verdict_errors(_decoded(spark, sf))
ORACLES["verdict_errors"] = rq("SELECT doc_key, error FROM dec WHERE error IS NOT NULL\n")

QUERIES["reason_clean"] = lambda spark, sf: R.verdicts_ok(_decoded(spark, sf)).select(
    "doc_key", P.reason_clean("reason").alias("reason_clean"))
ORACLES["reason_clean"] = rq("SELECT doc_key, replace(reason, '\"', '''') AS reason_clean FROM ok\n")


def q_verdict_join(spark, sf):
    j = R.verdict_join(_unclassified(spark, sf), _decoded(spark, sf))
    return j.select("doc_key", F.col("category").alias("category_before"), "category_after")


QUERIES["verdict_join"] = q_verdict_join
ORACLES["verdict_join"] = rq("""
SELECT u.doc_key, u.category AS category_before, coalesce(o.category, u.category) AS category_after
FROM unc u LEFT JOIN ok o ON o.doc_key = u.doc_key
""")


def q_patch_reclassified(spark, sf):
    j = R.verdict_join(_unclassified(spark, sf), _decoded(spark, sf))
    p = R.patch_reclassified(j, MODEL_NAME, RECLASS_TS)
    return p.select("doc_key", "category", "sync_blocked", F.col("llm.model").alias("llm_model"),
                    F.col("llm.confidence").alias("llm_confidence"), F.col("llm.reason").alias("llm_reason"),
                    F.col("llm.at").alias("llm_at"))


QUERIES["patch_reclassified"] = q_patch_reclassified
ORACLES["patch_reclassified"] = rq(f"""
SELECT u.doc_key, coalesce(o.category, u.category) AS category,
  CASE WHEN o.doc_key IS NOT NULL THEN o.category IN ('Personal-Health', 'Casual') ELSE false END AS sync_blocked,
  CASE WHEN o.doc_key IS NOT NULL THEN {sq(MODEL_NAME)} END AS llm_model,
  o.confidence AS llm_confidence,
  CASE WHEN o.doc_key IS NOT NULL THEN replace(o.reason, '"', '''') END AS llm_reason,
  CASE WHEN o.doc_key IS NOT NULL THEN {sq(RECLASS_TS)} END AS llm_at
FROM unc u LEFT JOIN ok o ON o.doc_key = u.doc_key
""")

QUERIES["reclass_counts"] = lambda spark, sf: R.reclass_counts(_decoded(spark, sf))
ORACLES["reclass_counts"] = rq("""
SELECT category, count(*) AS n_verdicts, sum(cache_read)::BIGINT AS cache_read, sum(cache_create)::BIGINT AS cache_create
FROM ok GROUP BY category
""")


def q_classify_model(spark, sf):
    batch = R.with_prompt(R.reclass_batch(_unclassified(spark, sf)))
    replies = R.classify_model(batch, R.keyword_scorer)
    return R.verdicts_ok(R.verdict_decode(replies)).select("doc_key", "category", "confidence", "cache_read")


def keyword_category(prompt: str) -> str:
    """DuckDB form of the stand-in scorer's choice."""
    return (f"CASE WHEN regexp_matches(lower({prompt}), 'clinic|health') THEN 'Personal-Health' "
            f"WHEN regexp_matches(lower({prompt}), 'family|friend') THEN 'Casual' "
            f"WHEN regexp_matches(lower({prompt}), 'lecture|course|class') THEN 'Learning' ELSE 'Business' END")


QUERIES["classify_model"] = q_classify_model
ORACLES["classify_model"] = rq(f"""
SELECT doc_key, {keyword_category('prompt')} AS category,
  CAST(0.6 AS DOUBLE) AS confidence, length(prompt) % 7 AS cache_read
FROM (SELECT doc_key, {PROMPT_SQL} AS prompt FROM unc)
""")
