"""Registered plans for document scans, headers, bundles and audit rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from recflow.fixtures import duckdb_with
from recflow.functions.projections import sync_flag
from recflow.operators import ingest, route
from recflow.operators.sinks import audit_events, audit_total, write_vault
from recflow.plans import enrich_plans as EP
from recflow.plans import ingest_plans as IP
from recflow.plans import oracle_headers as oh
from recflow.plans import reclass_plans as RP
from recflow.plans.common import ENRICH_TS, PULL_TS, RECLASS_TS, RUN_TS, fx
from recflow.plans.oracle_sql import DWS, blocked_case, category_case, py_strip, sq
from recflow.session import shared_dir
from recflow.sources import documents as D

QUERIES: dict = {}
ORACLES: dict = {}


def q_frontmatter_map(spark, sf):
    h = fx(spark, sf).headers
    return h.select("doc_id", F.explode(D.frontmatter_map("text")).alias("key", "value"))


QUERIES["frontmatter_map"] = q_frontmatter_map
ORACLES["frontmatter_map"] = duckdb_with(["headers"]) + f"""
SELECT doc_id, e.key AS key, e.value AS value FROM (
  SELECT doc_id, unnest(en) AS e, generate_subscripts(en, 1) AS i FROM (SELECT doc_id, {oh.entries('text')} AS en FROM headers))
QUALIFY row_number() OVER (PARTITION BY doc_id, e.key ORDER BY i DESC) = 1
"""

QUERIES["frontmatter_title"] = lambda spark, sf: fx(spark, sf).headers.select(
    "doc_id", D.frontmatter_title("text", "stem").alias("title"))
ORACLES["frontmatter_title"] = duckdb_with(["headers"]) + \
    f"SELECT doc_id, {oh.header_title('text', 'stem')} AS title FROM headers\n"


def q_section_extract(spark, sf):
    h = fx(spark, sf).headers
    s = D.section_extract("text", "AI Summary")
    return h.select("doc_id", F.length(s).alias("summary_chars"), F.md5(s).alias("summary_digest"),
                    D.section_extract("text", "Transcript").alias("transcript_section"))


_WS_NO_NL = "[" + DWS[1:-1].replace(r"\t\n", r"\t") + "]"


def _d_section(t: str, heading: str) -> str:
    pat = rf"(?ims)^## {_WS_NO_NL}*\Q{heading}\E{_WS_NO_NL}*$(.*?)(?:\n## [^\n]|\z)"
    return py_strip(f"regexp_extract({t}, {sq(pat)}, 1)")


QUERIES["section_extract"] = q_section_extract
ORACLES["section_extract"] = duckdb_with(["headers"]) + f"""
SELECT doc_id, length({_d_section('text', 'AI Summary')}) AS summary_chars,
  md5({_d_section('text', 'AI Summary')}) AS summary_digest,
  {_d_section('text', 'Transcript')} AS transcript_section FROM headers
"""

QUERIES["sibling_bundle"] = lambda spark, sf: route.sibling_bundle(
    fx(spark, sf).located, fx(spark, sf).files).select("directory", "stem", "file_name")
ORACLES["sibling_bundle"] = duckdb_with(["files", "located"]) + """
SELECT directory, stem, file_name FROM (SELECT f.directory, l.stem, f.file_name FROM located l
  JOIN files f ON f.directory = l.directory AND starts_with(f.file_name, l.stem))
QUALIFY row_number() OVER (PARTITION BY directory, file_name ORDER BY stem || '.md') = 1
"""


def q_audit_events(spark, sf):
    """The audit rows of all four stages: each document's event, failures with their
    reason, and a batch row with the totals."""
    outcome = IP._outcome(spark, sf)
    pulls = audit_events(outcome, "pull", PULL_TS, "recording_id", F.col("status"))
    r = route.classify_title(fx(spark, sf).recordings)
    detail = F.concat(F.col("category"), F.when(sync_flag("category"), F.lit(" [SYNC-BLOCKED]")).otherwise(F.lit("")))
    routes = audit_events(r, "route", RUN_TS, "stem", F.lit("routed"), detail)
    decoded = RP._decoded(spark, sf)
    failed = F.col("error").isNotNull()
    verdicts = audit_events(decoded, "reclassify", RECLASS_TS, "doc_key",
                            F.when(failed, "failed").otherwise("reclassified"), F.coalesce("error", "category"))
    run = EP._batch(spark, sf)
    hits = F.concat(F.lit("hits="), F.coalesce(F.size("entity_names"), F.lit(0)).cast("string"))
    names = run.names
    enriched = audit_events(run.facts.join(names, "doc_key", "left"), "enrich", ENRICH_TS, "doc_key", F.lit("enriched"), hits)
    totals = [audit_total(ingest.pull_counts(outcome), "pull", PULL_TS),
              audit_total(r.agg(F.count(F.lit(1)).alias("routed")), "route", RUN_TS),
              audit_total(decoded.agg(F.count_if(~failed).alias("reclassified"), F.count_if(failed).alias("failed")),
                          "reclassify", RECLASS_TS),
              audit_total(run.counts, "enrich", ENRICH_TS)]
    out = pulls.unionByName(routes).unionByName(verdicts).unionByName(enriched)
    for t in totals:
        out = out.unionByName(t)
    return out


QUERIES["audit_events"] = q_audit_events
ORACLES["audit_events"] = (
    IP.d_with(IP.D_CANDS, IP.D_META, IP.D_INBOX, IP.D_TX, IP.d_outcome(),
              views=("listing", "metadata", "ledger", "inbox", "replies", *EP.E_VIEWS)).rstrip("\n") + ","
    + re.sub(r"\bcands\b", "queue_cands", EP.E_CTES).rstrip("\n") + RP.R_CTES + f"""
, ev AS (
  SELECT {sq(PULL_TS)} AS ts, 'pull' AS stage, recording_id AS doc_key, status AS event, '' AS detail FROM outcome
  UNION ALL SELECT {sq(RUN_TS)}, 'route', doc_key, 'routed',
    category || CASE WHEN {blocked_case('category')} THEN ' [SYNC-BLOCKED]' ELSE '' END FROM edocs
  UNION ALL SELECT {sq(RECLASS_TS)}, 'reclassify', doc_key, CASE WHEN error IS NULL THEN 'reclassified' ELSE 'failed' END,
    coalesce(error, category) FROM dec
  UNION ALL SELECT {sq(ENRICH_TS)}, 'enrich', p.doc_key, 'enriched', 'hits=' || coalesce(m.n_hits, 0)
    FROM prep p LEFT JOIN mlist m ON m.doc_key = p.doc_key)
SELECT ts, stage, doc_key, event, detail FROM ev
UNION ALL SELECT {sq(PULL_TS)}, 'pull', '', 'batch', 'pulled=' || count(*) FILTER (WHERE event = 'pulled')
  || ' skipped=' || count(*) FILTER (WHERE event = 'skipped') || ' failed=' || count(*) FILTER (WHERE event = 'failed')
  FROM ev WHERE stage = 'pull'
UNION ALL SELECT {sq(RUN_TS)}, 'route', '', 'batch', 'routed=' || count(*) FROM ev WHERE stage = 'route'
UNION ALL SELECT {sq(RECLASS_TS)}, 'reclassify', '', 'batch', 'reclassified=' || count(*) FILTER (WHERE event = 'reclassified')
  || ' failed=' || count(*) FILTER (WHERE event = 'failed') FROM ev WHERE stage = 'reclassify'
UNION ALL SELECT {sq(ENRICH_TS)}, 'enrich', '', 'batch', 'enriched=' || (SELECT count(*) FROM pend)
  || ' skipped=' || ((SELECT count(*) FROM edocs) - (SELECT count(*) FROM pend))
  || ' entity_hits=' || (SELECT count(*) FROM mentions) || ' action_rollups=' || (SELECT count(*) FROM gated)
  || ' vdc_candidates=' || (SELECT count(*) FROM queue_cands)
""")


def q_scan_documents(spark, sf):
    """Route rendered documents into bucket folders (one file per document plus
    its summary sidecar, written from the tasks), then scan the folders back."""
    h = route.classify_title(D.parse_documents(fx(spark, sf).headers))
    root = shared_dir(spark, "vault")
    # document and sidecar come from one pass over the texts
    doc = F.struct("stem", "text")
    sidecar = F.struct(F.concat("stem", F.lit(".summary")).alias("stem"), F.col("summary").alias("text"))
    files = h.join(fx(spark, sf).summaries, "doc_id", "left").select(
        F.col("category").alias("bucket"), F.inline(F.when(F.col("summary").isNotNull(), F.array(doc, sidecar)).otherwise(F.array(doc))))
    write_vault(files, root).count()
    scanned = D.parse_documents(D.scan_documents(spark, root))
    return scanned.select("bucket", "stem", "title")


QUERIES["scan_documents"] = q_scan_documents
ORACLES["scan_documents"] = duckdb_with(["headers"]) + f"""
SELECT {category_case(oh.header_title('text', 'stem'))} AS bucket, stem, {oh.header_title('text', 'stem')} AS title
FROM headers
"""
