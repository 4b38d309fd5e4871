"""Registered streaming plans and their DuckDB oracles.

Each plan splits a derived table into two drops (even doc ids, then odd doc
ids plus repeats), runs the stream to completion with availableNow, adds the
second drop, runs it again from the same checkpoint and reads the sink back.
The results don't depend on the order of arrival within a drop.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from recflow.fixtures import duckdb_with
from recflow.functions import vocab
from recflow.operators.entities import load_entities
from recflow.plans import ingest_plans as IP
from recflow.operators.reclassify import keyword_scorer
from recflow.plans.common import ENRICH_TS, MODEL_NAME, PULL_TS, RECLASS_TS, RUN_DATE, fx
from recflow.plans.enrich_plans import E_CTES, E_VIEWS
from recflow.plans.oracle_sql import blocked_case, category_case, sq
from recflow.plans.reclass_plans import PROMPT_SQL, keyword_category
from recflow.session import TEXTS, shared_dir
from recflow.sources.ledger import Ledger
from recflow.sources.listing import inbox_ids
from recflow.streaming import model as M
from recflow.streaming import stages as S

QUERIES: dict = {}
ORACLES: dict = {}


def _drops(df, doc_col="doc_id"):
    """Split into two arrivals: even ids; odd ids plus repeats of ids % 4 = 0."""
    first = df.where(F.col(doc_col) % 2 == 0)
    second = df.where(F.col(doc_col) % 2 == 1).unionByName(df.where(F.col(doc_col) % 4 == 0))
    return first, second


def _ingest_env(spark, sf):
    f = fx(spark, sf)
    root = shared_dir(spark, "stream-ingest")
    listing = f.listing.withColumn("doc_id", F.floor(F.col("pos") / 8))
    l1, l2 = _drops(listing)
    rec = f.recordings.select("doc_id", "recording_id")
    tx = f.transcripts.join(rec, "doc_id")
    # transcripts of doc_id % 5 = 1 arrive late: those pulls fail first, then succeed on retry
    tx1 = tx.where(F.col("doc_id") % 5 != 1).select("recording_id", "transcript")
    tx2 = tx.where(F.col("doc_id") % 5 == 1).select("recording_id", "transcript")
    t = S.IngestTables(root=f"{root}/tables", metadata_path=f"{root}/metadata", summaries_path=f"{root}/summaries",
                       transcripts_path=f"{root}/transcripts", inbox_path=f"{root}/inbox", pulled_at=PULL_TS)
    f.metadata.write.parquet(t.metadata_path)
    f.summaries.join(rec, "doc_id").select("recording_id", "summary").write.options(**TEXTS).parquet(t.summaries_path)
    inbox_ids(f.inbox).write.parquet(t.inbox_path)
    Ledger(spark, t.ledger).append(f.ledger, -1)
    return root, t, (l1, tx1), (l2, tx2)


def _run_ingest(spark, sf, then=lambda root, t: None):
    """Both drops through the ingest stream, ``then(root, tables)`` after each."""
    root, t, d1, d2 = _ingest_env(spark, sf)
    ck = f"{root}/checkpoint"
    for i, (lines, tx) in enumerate((d1, d2)):
        (lines.repartitionByRange(2, "pos").sortWithinPartitions("pos").select("value")
         .write.text(f"{root}/listing/drop{i}"))
        tx.write.options(**TEXTS).mode("append").parquet(t.transcripts_path)
        q = S.start_ingest(spark, f"{root}/listing/*", t, f"{ck}/ingest")
        q.awaitTermination()
        then(root, t)
    return root, t


def q_stream_ingest(spark, sf):
    _root, t = _run_ingest(spark, sf)
    return spark.read.parquet(t.docs).select("recording_id", "doc_key", "text")


def q_retry_failed(spark, sf):
    """Every id whose pull failed in some batch, and whether a later batch pulled it."""
    _root, t = _run_ingest(spark, sf)
    failed = spark.read.parquet(t.retry).select("recording_id").distinct()
    docs = spark.read.parquet(t.docs).select("recording_id", F.lit(True).alias("pulled"))
    return failed.join(docs, "recording_id", "left").select("recording_id", F.coalesce("pulled", F.lit(False)).alias("pulled"))


def _route(spark, root, t):
    S.start_route(spark, t.docs, f"{root}/routed", f"{root}/checkpoint/route").awaitTermination()


def q_stream_route(spark, sf):
    root, _t = _run_ingest(spark, sf, lambda root, t: _route(spark, root, t))
    return spark.read.parquet(f"{root}/routed").select("recording_id", "category", "sync_blocked")


def _reclass(spark, root, t):
    _route(spark, root, t)
    stage = M.ModelStage(f"{root}/model", t.docs, MODEL_NAME, RECLASS_TS, scorer=keyword_scorer)
    M.start_reclass(spark, f"{root}/routed", stage, f"{root}/checkpoint/model").awaitTermination()


def q_stream_reclass(spark, sf):
    """The model's verdicts on the documents that the stream pulled and no rule matched."""
    root, _t = _run_ingest(spark, sf, lambda root, t: _reclass(spark, root, t))
    return S.read_or_empty(spark, f"{root}/model/verdicts", M.VERDICTS_SCHEMA).select(
        "recording_id", "category", "sync_blocked", F.col("llm.model").alias("llm_model"),
        F.col("llm.confidence").alias("llm_confidence"), F.col("llm.at").alias("llm_at"))


def _run_enrich(spark, sf):
    ents = load_entities(fx(spark, sf).entities_src)

    def stages(root, t):
        _reclass(spark, root, t)
        S.start_enrich(spark, f"{root}/routed", t.docs, ents, f"{root}/enriched", f"{root}/checkpoint/enrich", RUN_DATE, ENRICH_TS,
                       lambda batch: M.verdicts_on(spark, f"{root}/model", batch)).awaitTermination()

    root, _t = _run_ingest(spark, sf, stages)
    return f"{root}/enriched"


def q_stream_enrich(spark, sf):
    """The header patches of every document that the stream pulled and enriched."""
    return S.read_or_empty(spark, f"{_run_enrich(spark, sf)}/patches", S.PATCHES_SCHEMA).select(
        "recording_id", "entity_mentions", "action_items_rollup", "vdc_candidate", "enriched_category")


def _events_env(spark, sf):
    """(recording_id, recorded_at TIMESTAMP) events in two parquet drops."""
    f = fx(spark, sf)
    root = shared_dir(spark, "stream-events")
    ev = f.recordings.where(F.col("recorded_at") != "").select(
        "doc_id", "recording_id",
        F.to_timestamp(F.substring("recorded_at", 1, 19), "yyyy-MM-dd'T'HH:mm:ss").alias("recorded_at"))
    e1, e2 = _drops(ev)
    return root, e1.drop("doc_id"), e2.drop("doc_id")


def _run_events(spark, sf, each, then=lambda root: None):
    """Both drops through ``each(batch, batch_id, root)``, ``then(root)`` after each; returns the root folder."""
    root, e1, e2 = _events_env(spark, sf)
    for i, e in enumerate((e1, e2)):
        e.write.parquet(f"{root}/events/drop{i}")
        stream = (spark.readStream.schema("recording_id string, recorded_at timestamp")
                  .option("recursiveFileLookup", "true").parquet(f"{root}/events"))
        (stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
         .foreachBatch(lambda df, bid: each(df, bid, root)).start().awaitTermination())
        then(root)
    return root


def _deduplicated(spark, sf):
    root = _run_events(spark, sf, lambda df, bid, root: S.dedup_batch(df, bid, f"{root}/dedup") and None)
    return spark.read.parquet(f"{root}/dedup")


def q_stream_dedup(spark, sf):
    return _deduplicated(spark, sf).select("recording_id", F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss").alias("recorded_at"))


def q_late_arrivals(spark, sf):
    """Rows that arrived after a newer event of an earlier batch are kept and marked, and so
    are those that came later than the recorder's lateness allows."""
    return _deduplicated(spark, sf).select("recording_id", "late", "overdue")


def q_stream_daily_counts(spark, sf):
    def count(root):
        S.start_daily_counts(spark, f"{root}/dedup", f"{root}/daily", f"{root}/checkpoint-daily").awaitTermination()

    root = _run_events(spark, sf, lambda df, bid, root: S.dedup_batch(df, bid, f"{root}/dedup") and None, count)
    return S.daily_counts(spark, f"{root}/dedup", f"{root}/daily").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_recordings")


QUERIES.update({
    "stream_ingest": q_stream_ingest,
    "retry_failed": q_retry_failed,
    "stream_route": q_stream_route,
    "stream_reclass": q_stream_reclass,
    "stream_enrich": q_stream_enrich,
    "stream_dedup": q_stream_dedup,
    "late_arrivals": q_late_arrivals,
    "stream_daily_counts": q_stream_daily_counts,
})

# ---------------------------------------------------------------- oracle side

_OUTCOME = IP.d_with(IP.D_CANDS, IP.D_META, IP.D_INBOX, IP.D_TX, IP.d_outcome())
ORACLES["stream_ingest"] = IP.ORACLES["unified_document"]
ORACLES["retry_failed"] = _OUTCOME + """
SELECT DISTINCT b.recording_id, b.base = 'pulled' AS pulled
FROM base b LEFT JOIN recordings r ON r.recording_id = b.recording_id
WHERE b.base = 'failed' OR (b.base = 'pulled' AND (b.pos // 8) % 2 = 0 AND r.doc_id % 5 = 1)
"""
ORACLES["stream_route"] = _OUTCOME + f"""
SELECT recording_id, category, {blocked_case('category')} AS sync_blocked FROM (
  SELECT o.recording_id, {category_case('m.name')} AS category
  FROM outcome o JOIN meta m ON m.recording_id = o.recording_id WHERE o.status = 'pulled')
"""
#: verdicts of the stand-in model on pulled documents of the fallback bucket
_VERDICTS = f"""verdicts AS (
  SELECT recording_id, {keyword_category('prompt')} AS category FROM (
    SELECT recording_id, {PROMPT_SQL} AS prompt FROM (
      SELECT o.recording_id, m.name AS title, s.summary, {category_case('m.name')} AS category
      FROM outcome o JOIN meta m ON m.recording_id = o.recording_id JOIN recordings r ON r.recording_id = o.recording_id
      LEFT JOIN summaries s ON s.doc_id = r.doc_id WHERE o.status = 'pulled')
    WHERE category = {sq(vocab.FALLBACK_CATEGORY)}))"""
_OUTCOME_TEXTS = IP.d_with(IP.D_CANDS, IP.D_META, IP.D_INBOX, IP.D_TX, IP.d_outcome(),
                           views=("listing", "metadata", "ledger", "inbox", *E_VIEWS)).rstrip("\n") + ",\n" + _VERDICTS
ORACLES["stream_reclass"] = _OUTCOME_TEXTS + f"""
SELECT recording_id, category, {blocked_case('category')} AS sync_blocked, {sq(MODEL_NAME)} AS llm_model,
  CAST(0.6 AS DOUBLE) AS llm_confidence, {sq(RECLASS_TS)} AS llm_at FROM verdicts
"""
_PULLED_E = (re.sub(r"\bcands\b", "queue_cands", E_CTES).replace("SELECT doc_id, stem AS doc_key,", "SELECT doc_id, recording_id AS doc_key,")
             .replace("SELECT * FROM edocs WHERE status IS NULL OR status <> 'enriched'",
                      "SELECT e.* REPLACE (coalesce(v.category, e.category) AS category) FROM edocs e "
                      "LEFT JOIN verdicts v ON v.recording_id = e.doc_key "
                      "WHERE doc_key IN (SELECT recording_id FROM outcome WHERE status = 'pulled')"))
ORACLES["stream_enrich"] = _OUTCOME_TEXTS + "," + _PULLED_E + """
SELECT p.doc_key AS recording_id, coalesce(m.entity_mentions, '[]') AS entity_mentions,
  CASE WHEN g.doc_key IS NOT NULL THEN '"[[' || g.recorded_date || ']]"' END AS action_items_rollup,
  CASE WHEN c.doc_key IS NOT NULL THEN true END AS vdc_candidate, p.category AS enriched_category
FROM prep p LEFT JOIN mlist m ON m.doc_key = p.doc_key LEFT JOIN gated g ON g.doc_key = p.doc_key
LEFT JOIN queue_cands c ON c.doc_key = p.doc_key
"""
_EVENTS = duckdb_with(["recordings"]) + """, ev AS (
  SELECT doc_id, recording_id, replace(substring(recorded_at, 1, 19), 'T', ' ') AS recorded_at
  FROM recordings WHERE recorded_at <> '')
"""
ORACLES["stream_dedup"] = _EVENTS + "SELECT DISTINCT recording_id, recorded_at FROM ev\n"
ORACLES["late_arrivals"] = _EVENTS + """
SELECT recording_id, doc_id % 2 = 1 AND recorded_at < newest AS late,
  doc_id % 2 = 1 AND recorded_at[:10]::DATE <= newest[:10]::DATE - 90 AS overdue
FROM ev, (SELECT max(recorded_at) AS newest FROM ev WHERE doc_id % 2 = 0)
"""
ORACLES["stream_daily_counts"] = _EVENTS + """
SELECT substring(recorded_at, 1, 10) AS day, count(DISTINCT recording_id) AS n_recordings FROM ev GROUP BY 1
"""
