"""Registered plans for ingest (L1) and their DuckDB oracles."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from recflow.fixtures import duckdb_with
from recflow.functions import projections as P
from recflow.operators import ingest
from recflow.operators.sinks import unified_document
from recflow.plans.common import PULL_TS, fx
from recflow.plans.oracle_sql import sq
from recflow.sources import listing as L
from recflow.sources.documents import parse_documents  # noqa: F401  (re-exported for plans)

QUERIES: dict = {}
ORACLES: dict = {}

WINDOW_RUN_DATE = "2024-06-30"
WINDOW_DAYS = 90

# ---------------------------------------------------------------- Spark side


def _candidates(spark, sf):
    return L.listing_ids(fx(spark, sf).listing)


def _metadata(spark, sf):
    return L.metadata_fields(fx(spark, sf).metadata)


def _transcripts_by_id(spark, sf):
    f = fx(spark, sf)
    return f.transcripts.join(f.recordings.select("doc_id", "recording_id"), "doc_id")


def _inbox(spark, sf):
    return L.inbox_ids(fx(spark, sf).inbox)


def _outcome(spark, sf, cands=None):
    f = fx(spark, sf)
    return ingest.pull_outcome(cands if cands is not None else _candidates(spark, sf), f.ledger,
                               _inbox(spark, sf), _metadata(spark, sf), _transcripts_by_id(spark, sf))


# ---------------------------------------------------------------- oracle side

D_POSIX = r"[ \t\n\x{0B}\f\r]"
D_CANDS = f"""cands AS (
  SELECT pos, regexp_extract(value, '^[ \\t]*([^ \\t]+)', 1) AS recording_id FROM listing
  WHERE regexp_matches(value, {sq('^' + D_POSIX + '+[0-9a-f]{32}')}))"""


def d_meta_field(key: str) -> str:
    return (f"regexp_replace(array_to_string(list_transform(list_filter(string_split(coalesce(meta, ''), chr(10)), "
            f"lambda l: starts_with(l, {sq('  ' + key + ':')})), "
            f"lambda l: regexp_replace(l, {sq('^  ' + key + ':' + D_POSIX + '+')}, '')), chr(10)), "
            f"{sq(chr(92) + 'n+' + chr(92) + 'z')}, '')")


D_META = f"""meta AS (
  SELECT recording_id, {d_meta_field('name')} AS name, {d_meta_field('start_at')} AS start_at,
    {d_meta_field('created_at')} AS created_at, {d_meta_field('duration')} AS duration,
    {d_meta_field('serial_number')} AS serial,
    len(list_filter(string_split(coalesce(meta, ''), chr(10)), lambda l: starts_with(l, '  name:'))) > 0 AS meta_valid
  FROM metadata)"""
D_INBOX = r"""inb AS (
  SELECT DISTINCT regexp_extract(text, '(?m)^recording_id: ([0-9a-f]{32})', 1) AS recording_id
  FROM inbox WHERE regexp_matches(regexp_extract(file_name, '([^/]*)$', 1), '(?s)--.{8}\.md\z')
    AND regexp_matches(text, '(?m)^recording_id: [0-9a-f]{32}'))"""
D_TX = """tx AS (SELECT DISTINCT r.recording_id FROM transcripts t JOIN recordings r ON r.doc_id = t.doc_id)"""


def d_outcome(cands: str = "cands") -> str:
    return f"""base AS (
  SELECT c.pos, c.recording_id,
    CASE WHEN c.recording_id IN (SELECT recording_id FROM ledger)
           OR c.recording_id IN (SELECT recording_id FROM inb) THEN 'skipped'
         WHEN NOT coalesce(m.meta_valid, false) THEN 'failed'
         WHEN c.recording_id NOT IN (SELECT recording_id FROM tx) THEN 'failed'
         ELSE 'pulled' END AS base
  FROM {cands} c LEFT JOIN meta m ON m.recording_id = c.recording_id),
fp AS (SELECT recording_id, min(pos) AS first_pos FROM base WHERE base = 'pulled' GROUP BY recording_id),
outcome AS (
  SELECT b.pos, b.recording_id, CASE WHEN b.pos > fp.first_pos THEN 'skipped' ELSE b.base END AS status
  FROM base b LEFT JOIN fp ON fp.recording_id = b.recording_id)"""


def d_with(*ctes: str, views=("listing", "metadata", "ledger", "inbox", "transcripts", "recordings", "summaries")) -> str:
    head = duckdb_with(list(views))
    return head.rstrip("\n") + ",\n" + ",\n".join(ctes) + "\n"


_UP, _LO = string.ascii_uppercase, string.ascii_lowercase


def d_slug(x: str) -> str:
    return (f"substring(regexp_replace(regexp_replace(translate({x}, '{_UP}', '{_LO}'), '[^a-z0-9]+', '-', 'g'), "
            f"'^-+|-+$', '', 'g'), 1, 60)")


def d_date_prefix(start: str, created: str) -> str:
    return f"split_part(coalesce(nullif({start}, ''), {created}, ''), 'T', 1)"


def d_doc_key(start, created, name, rid) -> str:
    return f"{d_date_prefix(start, created)} || '--' || {d_slug(name)} || '--' || left({rid}, 8)"


# ---------------------------------------------------------------- plans

QUERIES["listing_ids"] = lambda spark, sf: _candidates(spark, sf)
ORACLES["listing_ids"] = d_with(D_CANDS) + "SELECT pos, recording_id FROM cands\n"

QUERIES["batch_dedup"] = lambda spark, sf: ingest.batch_dedup(_candidates(spark, sf))
ORACLES["batch_dedup"] = d_with(D_CANDS) + \
    "SELECT recording_id, min(pos) AS pos FROM cands GROUP BY recording_id\n"

QUERIES["metadata_fields"] = lambda spark, sf: _metadata(spark, sf).select(
    "recording_id", "name", "start_at", "created_at", "duration", "serial", "meta_valid")
ORACLES["metadata_fields"] = d_with(D_META) + \
    "SELECT recording_id, name, start_at, created_at, duration, serial, meta_valid FROM meta\n"

QUERIES["valid_metadata"] = lambda spark, sf: (
    _metadata(spark, sf).groupBy("meta_valid").agg(F.count(F.lit(1)).alias("n_recordings")))
ORACLES["valid_metadata"] = d_with(D_META) + \
    "SELECT meta_valid, count(*) AS n_recordings FROM meta GROUP BY meta_valid\n"

QUERIES["ledger_scan"] = lambda spark, sf: fx(spark, sf).ledger.select("recording_id").distinct()
ORACLES["ledger_scan"] = duckdb_with(["ledger"]) + "SELECT DISTINCT recording_id FROM ledger\n"

QUERIES["anti_ledger"] = lambda spark, sf: ingest.anti_ledger(_candidates(spark, sf), fx(spark, sf).ledger)
ORACLES["anti_ledger"] = d_with(D_CANDS) + \
    "SELECT pos, recording_id FROM cands WHERE recording_id NOT IN (SELECT recording_id FROM ledger)\n"

QUERIES["anti_short_id"] = lambda spark, sf: ingest.anti_short_id(_candidates(spark, sf), _inbox(spark, sf))
ORACLES["anti_short_id"] = d_with(D_CANDS, D_INBOX) + \
    "SELECT pos, recording_id FROM cands WHERE recording_id NOT IN (SELECT recording_id FROM inb)\n"


def q_inbox_exists(spark, sf):
    return _candidates(spark, sf).join(_inbox(spark, sf), "recording_id", "left_semi").select("pos", "recording_id")


QUERIES["inbox_exists"] = q_inbox_exists
ORACLES["inbox_exists"] = d_with(D_CANDS, D_INBOX) + \
    "SELECT pos, recording_id FROM cands WHERE EXISTS (SELECT 1 FROM inb WHERE inb.recording_id = cands.recording_id)\n"

QUERIES["pull_outcome"] = _outcome
ORACLES["pull_outcome"] = d_with(D_CANDS, D_META, D_INBOX, D_TX, d_outcome()) + \
    "SELECT pos, recording_id, status FROM outcome\n"

QUERIES["pull_counts"] = lambda spark, sf: ingest.pull_counts(_outcome(spark, sf))
ORACLES["pull_counts"] = d_with(D_CANDS, D_META, D_INBOX, D_TX, d_outcome()) + """
SELECT count(*) FILTER (WHERE status = 'pulled') AS pulled, count(*) FILTER (WHERE status = 'skipped') AS skipped,
  count(*) FILTER (WHERE status = 'failed') AS failed FROM outcome
"""

QUERIES["ledger_append"] = lambda spark, sf: ingest.ledger_append(_outcome(spark, sf))
ORACLES["ledger_append"] = d_with(D_CANDS, D_META, D_INBOX, D_TX, d_outcome()) + \
    "SELECT recording_id FROM outcome WHERE status = 'pulled'\n"


def q_explicit_ids(spark, sf):
    ids = L.explicit_ids(fx(spark, sf).recordings, pos="doc_id")
    return _outcome(spark, sf, ids).select("recording_id", "status")


QUERIES["explicit_ids"] = q_explicit_ids
ORACLES["explicit_ids"] = d_with(
    "ecands AS (SELECT doc_id AS pos, recording_id FROM recordings)", D_META, D_INBOX, D_TX, d_outcome("ecands")) + \
    "SELECT recording_id, status FROM outcome\n"


def q_discovery_window(spark, sf):
    r = fx(spark, sf).recordings.withColumn("day", P.date_prefix("recorded_at", "uploaded_at"))
    return ingest.discovery_window(r, "day", WINDOW_RUN_DATE, WINDOW_DAYS).select("doc_id", "day")


QUERIES["discovery_window"] = q_discovery_window
ORACLES["discovery_window"] = duckdb_with(["recordings"]) + f"""
SELECT doc_id, day FROM (SELECT doc_id, {d_date_prefix('recorded_at', 'uploaded_at')} AS day FROM recordings)
WHERE day >= '2024-04-01' AND day <= '{WINDOW_RUN_DATE}'
"""


def _projected(spark, sf):
    return _metadata(spark, sf).select(
        "recording_id",
        P.slug("name").alias("slug"), P.short_id("recording_id").alias("short_id"),
        P.date_prefix("start_at", "created_at").alias("date_prefix"),
        P.doc_key("start_at", "created_at", "name", "recording_id").alias("doc_key"))


for _k in ("slug", "short_id", "date_prefix", "doc_key"):
    QUERIES[_k] = (lambda k: lambda spark, sf: _projected(spark, sf).select("recording_id", k))(_k)
_d_proj = {
    "slug": d_slug("name"), "short_id": "left(recording_id, 8)",
    "date_prefix": d_date_prefix("start_at", "created_at"),
    "doc_key": d_doc_key("start_at", "created_at", "name", "recording_id"),
}
for _k, _e in _d_proj.items():
    ORACLES[_k] = d_with(D_META) + f"SELECT recording_id, {_e} AS {_k} FROM meta\n"


def q_title_roundtrip(spark, sf):
    r = fx(spark, sf).recordings
    line = F.concat(F.lit("title: "), P.title_escape("title"))
    back = P.title_unquote(F.regexp_replace(line, r"\A[^:]*:", ""))
    return r.select("doc_id", "title", back.alias("title_read"))


QUERIES["title_quote_roundtrip"] = q_title_roundtrip
ORACLES["title_quote_roundtrip"] = duckdb_with(["recordings"]) + r"""
SELECT doc_id, title,
  regexp_replace(regexp_replace(' "' || replace(title, '"', '\"') || '"',
    '\A[\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+\z', '', 'g'),
    '\A"+|"+\z', '', 'g') AS title_read
FROM recordings
"""

QUERIES["has_summary"] = lambda spark, sf: fx(spark, sf).summaries.select(
    "doc_id", P.has_summary("summary").alias("has_summary"))
ORACLES["has_summary"] = duckdb_with(["summaries"]) + \
    "SELECT doc_id, length(coalesce(summary, '')) > 0 AS has_summary FROM summaries\n"


def q_transcript_text(spark, sf):
    from recflow.sources.transcripts import transcript_text
    return transcript_text(fx(spark, sf).conversations, "conv_id")


QUERIES["transcript_text"] = q_transcript_text
ORACLES["transcript_text"] = duckdb_with(["conversation_text"]) + "SELECT conv_id, transcript FROM conversation_text\n"


def q_ledger_seed(spark, sf):
    return L.ledger_seed(fx(spark, sf).headers).orderBy("recording_id")


QUERIES["ledger_seed"] = q_ledger_seed
ORACLES["ledger_seed"] = duckdb_with(["headers"]) + r"""
SELECT DISTINCT CASE WHEN substring(m, 14, 1) IN (' ', chr(9)) THEN right(m, 32) ELSE '' END AS recording_id
FROM (SELECT unnest(regexp_extract_all(text, '(?m)^recording_id:[ \t\x{0B}\f\r]*[0-9a-f]{32}')) AS m FROM headers)
ORDER BY 1
"""


def _pulled_docs(spark, sf):
    f = fx(spark, sf)
    pulled = ingest.ledger_append(_outcome(spark, sf))
    meta = ingest.one_per_recording(_metadata(spark, sf).drop("meta"))
    rec = f.recordings.select("doc_id", "recording_id")
    return (pulled.join(meta, "recording_id").join(rec, "recording_id")
            .join(f.summaries, "doc_id", "left").join(f.transcripts, "doc_id", "left"))


def q_unified_document(spark, sf):
    d = _pulled_docs(spark, sf)
    return d.select("recording_id",
                    P.doc_key("start_at", "created_at", "name", "recording_id").alias("doc_key"),
                    unified_document(d, PULL_TS).alias("text"))


QUERIES["unified_document"] = q_unified_document
ORACLES["unified_document"] = d_with(D_CANDS, D_META, D_INBOX, D_TX, d_outcome()) + f"""
SELECT o.recording_id, {d_doc_key('m.start_at', 'm.created_at', 'm.name', 'o.recording_id')} AS doc_key,
  '---' || chr(10) || 'source: recorder' || chr(10)
  || 'recording_id: ' || o.recording_id || chr(10)
  || 'recording_serial: ' || coalesce(m.serial, '') || chr(10)
  || 'title: "' || replace(coalesce(m.name, ''), '"', '\\"') || '"' || chr(10)
  || 'recorded_at: ' || coalesce(m.start_at, '') || chr(10)
  || 'uploaded_at: ' || coalesce(m.created_at, '') || chr(10)
  || 'duration_human: ' || coalesce(m.duration, '') || chr(10)
  || 'pulled_at: {PULL_TS}' || chr(10) || 'pulled_via: ingest' || chr(10)
  || 'ingestion_status: untriaged' || chr(10)
  || 'ai_summary: ' || CASE WHEN length(coalesce(s.summary, '')) > 0 THEN 'true' ELSE 'false' END || chr(10)
  || 'tags: [transcript, recorder, capture]' || chr(10) || '---' || chr(10)
  || chr(10) || '# ' || coalesce(m.name, '') || chr(10) || chr(10)
  || '> Pulled by the ingest job. Raw sidecars: `.transcript.txt`, `.summary.md`.' || chr(10) || chr(10)
  || CASE WHEN length(coalesce(s.summary, '')) > 0 THEN '## AI Summary' || chr(10) || chr(10) || s.summary || chr(10) ELSE '' END
  || '## Transcript' || chr(10) || chr(10) || '```text' || chr(10) || coalesce(t.transcript, '') || '```' || chr(10) AS text
FROM outcome o JOIN meta m ON m.recording_id = o.recording_id
JOIN recordings r ON r.recording_id = o.recording_id
LEFT JOIN summaries s ON s.doc_id = r.doc_id LEFT JOIN transcripts t ON t.doc_id = r.doc_id
WHERE o.status = 'pulled'
"""
