"""Derived views over the driver tables.

The raw ``documents`` / ``conversations`` tables carry none of the structure
the operators act on (no headers, headings, rule words ...).  Each view below
injects that structure as a deterministic function of the keys, in SQL that
Spark and DuckDB evaluate identically (no regexes, no backslash escapes,
``chr(10)`` for newlines).  Every view grows with the tables it reads.

The same SQL text is used on both engines: Spark runs it over temp views of
the parquet tables, the DuckDB oracle inlines it as CTEs.  Views that need
engine-specific syntax carry two variants.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import DataFrame, SparkSession

from recflow.functions import vocab

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]

NL = "chr(10)"

_ALL_KEYWORDS = [w for _, _, words in vocab.ROUTING_RULES for w in words]
# every routing keyword in turn (the patterns among them in their plain spelling)
_KEYWORD = ("CASE cast(floor(doc_id / 8) as bigint) % " + str(len(_ALL_KEYWORDS)) + " "
            + " ".join(f"WHEN {i} THEN '{w.replace('?', '').replace(chr(92), '').replace(chr(39), chr(39) * 2)}'"
                       for i, w in enumerate(_ALL_KEYWORDS)) + " END")
# the beginning of the document's own text, on one line
_OPENING = f"left(replace(replace(coalesce(text, ''), {NL}, ' '), chr(92), ' '), 40)"

_TITLE = f"""CASE doc_id % 8
      WHEN 0 THEN 'Client strategy review'
      WHEN 1 THEN 'Family catch-up'
      WHEN 2 THEN 'Spark training workshop'
      WHEN 3 THEN 'Doctor visit notes'
      WHEN 4 THEN 'Memo'
      WHEN 5 THEN 'Job ob_x list'
      WHEN 6 THEN 'Notes on ' || {_KEYWORD}
      ELSE 'Product demo pipeline' END
    || ' ' || cast(doc_id as string) || ' ' || {_OPENING}
    || CASE doc_id % 10 WHEN 3 THEN ' "final" cut' WHEN 7 THEN ' at Caf' || chr(233) || ' Z' || chr(252) || 'rich' ELSE '' END"""

_DAY = ("'2024-' || lpad(cast(doc_id % 12 + 1 as string), 2, '0') || '-' "
        "|| lpad(cast(doc_id % 28 + 1 as string), 2, '0')")

VIEWS: dict[str, dict] = {}


def _view(name, deps, sql=None, spark=None, duckdb=None):
    VIEWS[name] = {"deps": deps, "spark": spark or sql, "duckdb": duckdb or sql}


# recordings: one per document.  Title picks a routing branch by doc_id % 8,
# some titles carry quotes or accents; every 13th recorded_at is empty and
# every 26th uploaded_at too (forcing the run-date fallback).
_view("recordings", ["documents"], f"""
SELECT doc_id,
  md5(cast(doc_id as string)) AS recording_id,
  'rec-' || lpad(cast(doc_id as string), 19, '0') || '--' || left(md5(cast(doc_id as string)), 8) AS stem,
  {_TITLE} AS title,
  CASE WHEN doc_id % 13 = 0 THEN '' ELSE {_DAY} || 'T09:' || lpad(cast(doc_id % 60 as string), 2, '0') || ':00+00:00' END AS recorded_at,
  CASE WHEN doc_id % 26 = 0 THEN '' ELSE {_DAY} || 'T18:30:00+00:00' END AS uploaded_at,
  cast(cast(floor(n_chars / 60) as bigint) as string) || 'm ' || cast(n_chars % 60 as string) || 's' AS duration_human,
  'SN-' || lpad(cast(doc_id % 97 as string), 4, '0') AS serial,
  CASE WHEN doc_id % 10 = 9 THEN 'enriched' WHEN doc_id % 23 = 0 THEN NULL ELSE 'routed' END AS status
FROM $documents
""")

_SIGNAL = """CASE doc_id % 10 WHEN 0 THEN 'closed' WHEN 1 THEN 'shipped' WHEN 2 THEN 'delivered'
      WHEN 3 THEN 'wrapped' WHEN 4 THEN 'live' WHEN 5 THEN 'launched' WHEN 6 THEN 'signed'
      WHEN 7 THEN 'deployed' WHEN 8 THEN 'in production' ELSE 'went live' END"""

_ACTION_BLOCK = f"""CASE doc_id % 5
    WHEN 0 THEN '## Next Steps' || {NL}
      || '- [ ] Send the revised proposal to the team ' || cast(doc_id as string) || {NL}
      || '- [x] Book a follow-up call' || {NL}
      || '- insert more items here' || {NL}
      || '- Owners:' || {NL}
      || '- @Dana Smith' || {NL}
      || '- short' || {NL}
      || '* Draft the integration plan by Friday' || {NL}
      || '> - Review the budget numbers' || {NL}
      || {NL} || '## Notes' || {NL}
      || '- This bullet sits after the section' || {NL}
    WHEN 1 THEN '- Action Items:' || {NL}
      || '  - Call the vendor about pricing ' || cast(doc_id as string) || {NL}
      || '  - Ship' || {NL}
      || '  - Update the shared tracker' || {NL}
      || '---' || {NL}
      || '- Ignored after the rule line' || {NL}
    WHEN 2 THEN '### Plan' || {NL}
      || '## Timeline' || {NL}
      || '- Book the venue for March ' || cast(doc_id as string) || {NL}
      || '1. Numbered lines are not bullets' || {NL}
    ELSE '' END"""

# summaries: the whole document text plus injected entity names, a delivery
# phrase and one of three action-item layouts; none when doc_id % 11 = 0.
_SUMMARY = f"""CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE
    '# Summary of recording ' || cast(d.doc_id as string) || {NL} || {NL}
    || d.text || {NL} || {NL}
    || CASE WHEN d.doc_id % 9 < 6 THEN 'We met with ' || s.s_name || ' about the rollout.' || {NL} ELSE '' END
    || CASE WHEN d.doc_id % 3 = 0 THEN 'Attendees included ' || lower(c.c_name) || '.' || {NL} ELSE '' END
    || 'Discussed the ' || upper(p.p_name) || '.' || {NL}
    || CASE WHEN d.doc_id % 7 < 3 THEN 'Status: the work was ' || {_SIGNAL.replace('doc_id', 'd.doc_id')} || ' last week.' || {NL} ELSE '' END
    || {NL} || {_ACTION_BLOCK.replace('doc_id', 'd.doc_id')}
  END AS summary"""
# On Spark the names are joined to the distinct ids, and the texts move once, to
# their id; the same rows as joining each name table to the texts.
_view("summaries", ["documents", "supplier", "customer", "part"],
      spark=f"""
SELECT d.doc_id,
  {_SUMMARY.replace('s.s_name', 'n.s_name').replace('c.c_name', 'n.c_name').replace('p.p_name', 'n.p_name')}
FROM $documents d
JOIN (
  SELECT k.doc_id, s.s_name, c.c_name, p.p_name FROM (SELECT DISTINCT doc_id FROM $documents) k
  JOIN $supplier s ON s.s_suppkey = k.doc_id % (SELECT count(*) FROM $supplier)
  JOIN $customer c ON c.c_custkey = k.doc_id % (SELECT count(*) FROM $customer)
  JOIN $part p ON p.p_partkey = k.doc_id % (SELECT count(*) FROM $part)) n ON n.doc_id = d.doc_id
""",
      duckdb=f"""
SELECT d.doc_id,
  {_SUMMARY}
FROM $documents d
JOIN $supplier s ON s.s_suppkey = d.doc_id % (SELECT count(*) FROM $supplier)
JOIN $customer c ON c.c_custkey = d.doc_id % (SELECT count(*) FROM $customer)
JOIN $part p ON p.p_partkey = d.doc_id % (SELECT count(*) FROM $part)
""")

# conversation_text: speaker-attributed transcript per conversation.
_view("conversation_text", ["conversations"],
      spark="""
SELECT conv_id,
  array_join(transform(array_sort(collect_list(named_struct('turn', turn, 'line', role || ': ' || text))), x -> x.line), chr(10)) AS transcript
FROM $conversations GROUP BY conv_id
""",
      duckdb="""
SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM $conversations GROUP BY conv_id
""")

# transcripts: the conversation doc_id % n_conv; for doc_id % 9 >= 6 the
# document text follows and then a supplier name (often past 8000 chars);
# none when doc_id % 17 = 0.  On Spark the texts that follow move once, to their id.
_view("transcripts", ["documents", "conversation_text", "supplier"],
      spark=f"""
SELECT d.doc_id,
  n.transcript
    || CASE WHEN d.doc_id % 9 >= 6 THEN {NL} || 'user: ' || d.tail || {NL} || 'assistant: Thanks to ' || n.s_name || '.' ELSE '' END
    AS transcript
FROM (SELECT doc_id, CASE WHEN doc_id % 9 >= 6 THEN text END AS tail FROM $documents WHERE doc_id % 17 <> 0) d
JOIN (
  SELECT k.doc_id, k.s_name, t.transcript FROM (
    SELECT i.doc_id, s.s_name, i.doc_id % (SELECT count(*) FROM $conversation_text) AS conv_id
    FROM (SELECT DISTINCT doc_id FROM $documents WHERE doc_id % 17 <> 0) i
    JOIN $supplier s ON s.s_suppkey = (i.doc_id + 1) % (SELECT count(*) FROM $supplier)) k
  JOIN $conversation_text t ON t.conv_id = k.conv_id) n ON n.doc_id = d.doc_id
""",
      duckdb=f"""
SELECT d.doc_id,
  t.transcript
    || CASE WHEN d.doc_id % 9 >= 6 THEN {NL} || 'user: ' || d.text || {NL} || 'assistant: Thanks to ' || s.s_name || '.' ELSE '' END
    AS transcript
FROM $documents d
JOIN $conversation_text t ON t.conv_id = d.doc_id % (SELECT count(*) FROM $conversation_text)
JOIN $supplier s ON s.s_suppkey = (d.doc_id + 1) % (SELECT count(*) FROM $supplier)
WHERE d.doc_id % 17 <> 0
""")

# entities_src: People (customers), Companies (suppliers), Projects (part
# names, repeated), plus 3-letter names (dropped) and an upper-cased copy of
# every supplier filed under Projects (loses to Companies).
_view("entities_src", ["customer", "supplier", "part"], """
SELECT c_name AS name, 'People' AS type FROM $customer
UNION ALL SELECT s_name AS name, 'Companies' AS type FROM $supplier
UNION ALL SELECT p_name AS name, 'Projects' AS type FROM $part
UNION ALL SELECT left(p_name, 3) AS name, 'Projects' AS type FROM $part
UNION ALL SELECT upper(s_name) AS name, 'Projects' AS type FROM $supplier
""")

# listing: what the recorder's "recent" command prints.  Good lines for every
# recording (repeated for doc_id % 10 = 0), plus lines that must not parse.
_view("listing", ["recordings"], """
SELECT doc_id * 8 AS pos, '  ' || recording_id || '  ' || title AS value FROM $recordings
UNION ALL SELECT doc_id * 8 + 1, '  ' || recording_id || '  ' || title || ' (again)' FROM $recordings WHERE doc_id % 10 = 0
UNION ALL SELECT doc_id * 8 + 2, '  ' || upper(recording_id) || '  upper-case id' FROM $recordings WHERE doc_id % 7 = 0
UNION ALL SELECT doc_id * 8 + 3, recording_id || '  not indented' FROM $recordings WHERE doc_id % 9 = 0
UNION ALL SELECT doc_id * 8 + 4, '  ' || left(recording_id, 31) || '  short id' FROM $recordings WHERE doc_id % 11 = 0
UNION ALL SELECT doc_id * 8 + 5, chr(9) || md5(recording_id) || 'ff  longer token' FROM $recordings WHERE doc_id % 12 = 0
UNION ALL SELECT doc_id * 8 + 6, 'ID                                NAME' FROM $recordings WHERE doc_id % 50 = 0
""")

# metadata: five "  key: value" lines per recording; the name line is
# missing when doc_id % 19 = 0, and an extra unrelated line is present.
_view("metadata", ["recordings"], f"""
SELECT recording_id,
  'file ' || recording_id || {NL}
  || CASE WHEN doc_id % 19 = 0 THEN '' ELSE '  name: ' || title || {NL} END
  || '  start_at: ' || recorded_at || {NL}
  || '  created_at: ' || uploaded_at || {NL}
  || '  duration: ' || duration_human || {NL}
  || '  serial_number: ' || serial || {NL}
  || '  filesize: ' || cast(doc_id * 1000 as string) AS meta
FROM $recordings
""")

# ledger: ids already pulled (doc_id % 4 = 0) plus ids of other recorders.
_view("ledger", ["recordings"], """
SELECT recording_id FROM $recordings WHERE doc_id % 4 = 0
UNION ALL SELECT md5(recording_id) AS recording_id FROM $recordings WHERE doc_id % 5 = 0
""")

# inbox: files still in the vault tree.  doc_id % 6 = 1 left a document whose
# header holds its id; sidecars and other names must not count, nor does another
# recording whose id only begins alike (doc_id % 6 = 5).
_view("inbox", ["recordings"], f"""
SELECT 'Business/2023-12-01--older-note--' || left(recording_id, 8) || '.md' AS file_name,
  '---' || {NL} || 'recording_id: ' || recording_id || {NL} || '---' || {NL} || title AS text FROM $recordings WHERE doc_id % 6 = 1
UNION ALL SELECT '_raw/2023-12-01--older-note--' || left(recording_id, 8) || '.summary.md', title FROM $recordings WHERE doc_id % 6 = 2
UNION ALL SELECT 'Casual/' || left(recording_id, 8) || '.md', 'recording_id: ' || recording_id FROM $recordings WHERE doc_id % 6 = 3
UNION ALL SELECT 'Learning/2023-12-02--other--' || left(recording_id, 8) || '.md',
  '---' || {NL} || 'recording_id: ' || left(recording_id, 8) || '000000000000000000000000' || {NL} || '---' FROM $recordings WHERE doc_id % 6 = 5
""")

# headers: rendered documents with header variants by doc_id % 7:
# 0 no header, 1 repeated title key, 2 indented line + line without ':',
# 3 escaped quotes in the title, 4 value containing ':', 5 unclosed header,
# 6 plain.  The body always holds an "AI Summary" and a "Transcript" section.
_view("headers", ["recordings", "summaries"], f"""
SELECT r.doc_id, r.stem,
  CASE WHEN r.doc_id % 7 = 0 THEN '' ELSE
    '---' || {NL}
    || 'source: recorder' || {NL}
    || 'recording_id: ' || r.recording_id || {NL}
    || 'title: "' || replace(r.title, '"', chr(92) || '"') || '"' || {NL}
    || CASE WHEN r.doc_id % 7 = 1 THEN 'title: Second title ' || cast(r.doc_id as string) || {NL} ELSE '' END
    || CASE WHEN r.doc_id % 7 = 2 THEN '  nested: skipped' || {NL} || 'no colon here' || {NL} ELSE '' END
    || CASE WHEN r.doc_id % 7 = 3 THEN 'note: "say ' || chr(92) || '"hi' || chr(92) || '""' || {NL} ELSE '' END
    || CASE WHEN r.doc_id % 7 = 4 THEN 'link: https://example.org/a:b' || {NL} ELSE '' END
    || 'recorded_at: ' || r.recorded_at || {NL}
    || 'ingestion_status: untriaged' || {NL}
    || CASE WHEN r.doc_id % 7 = 5 THEN '' ELSE '---' || {NL} END
  END
  || {NL} || '# ' || r.title || {NL} || {NL}
  || CASE WHEN s.summary IS NULL THEN '' ELSE '## AI Summary' || {NL} || {NL} || s.summary || {NL} END
  || '##  transcript ' || {NL} || {NL} || 'speaker: hello ' || cast(r.doc_id as string) || {NL}
  AS text
FROM $recordings r JOIN $summaries s ON s.doc_id = r.doc_id
""")

# replies: raw model replies by doc_id % 9: 0 valid, 1 fenced, 2 truncated
# JSON naming a category, 3 prose naming two categories, 4 unknown prose,
# 5 JSON array, 6 object without category, 7 confidence as text, 8 text after the
# object, confidence text that is no number, a category outside the list.
_view("replies", ["recordings"], f"""
SELECT doc_id, stem, CASE doc_id % 9
  WHEN 0 THEN '{{"category": "Business", "confidence": 0.9, "reason": "Talks about ' || chr(92) || '"client' || chr(92) || '" work ' || cast(doc_id as string) || '"}}'
  WHEN 1 THEN '```json' || {NL} || '{{"category": "Learning", "confidence": 0.75, "reason": "lecture"}}' || {NL} || '```'
  WHEN 2 THEN '{{"category": "Casual", "confidence": 0.'
  WHEN 3 THEN 'I think this is Business, maybe Personal-Health.'
  WHEN 4 THEN 'no idea what this is about, recording ' || cast(doc_id as string)
  WHEN 5 THEN '["Business"]'
  WHEN 6 THEN '{{"confidence": 0.4}}'
  WHEN 7 THEN '  {{"category": "Learning", "confidence": "0.7", "reason": "r"}}  '
  ELSE CASE doc_id % 45
    WHEN 8 THEN '{{"category": "Casual", "confidence": 0.9}}]'
    WHEN 17 THEN '{{"category": "Casual", "confidence": 0.9}}], [1'
    WHEN 26 THEN '{{"category": "Casual", "confidence": "1.0d"}}'
    WHEN 35 THEN '{{"category": "Casual", "confidence": "0x1p3"}}'
    ELSE '{{"category": "Finance", "confidence": 0.6}}' END END AS raw,
  (doc_id % 3) * 100 AS cache_read,
  CASE WHEN doc_id % 50 = 0 THEN 1200 ELSE 0 END AS cache_create
FROM $recordings
""")


# files: directory listings.  Every recording has its .md, sidecars
# where they exist, and for doc_id % 10 = 0 a longer name that starts with the
# stem (bundled with it); doc_id % 15 = 0 adds a short name that few stems begin,
# doc_id % 20 = 0 a sidecar of the same name in another directory.
_view("files", ["recordings", "summaries", "transcripts"], """
SELECT '_raw' AS directory, stem || '.md' AS file_name FROM $recordings
UNION ALL SELECT '_raw', r.stem || '.summary.md' FROM $recordings r JOIN $summaries s ON s.doc_id = r.doc_id WHERE s.summary IS NOT NULL
UNION ALL SELECT '_raw', r.stem || '.transcript.txt' FROM $recordings r JOIN $transcripts t ON t.doc_id = r.doc_id
UNION ALL SELECT '_raw', stem || ' (conflict).md' FROM $recordings WHERE doc_id % 10 = 0
UNION ALL SELECT '_raw', left(stem, 24) || '.md' FROM $recordings WHERE doc_id % 15 = 0
UNION ALL SELECT 'Business', stem || '.summary.md' FROM $recordings WHERE doc_id % 20 = 0
""")

# located: where each document lies; for doc_id % 30 = 0 there is also one whose
# stem is the beginning of the recording's (their files have two candidates).
_view("located", ["recordings"], """
SELECT '_raw' AS directory, stem FROM $recordings
UNION ALL SELECT '_raw', left(stem, 24) FROM $recordings WHERE doc_id % 30 = 0
""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen or n in BASE_TABLES:
            return
        for d in VIEWS[n]["deps"]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def duckdb_with(names: list[str]) -> str:
    """``WITH`` clause defining the given views (and their dependencies)."""
    parts = []
    for n in _order(names):
        sql = VIEWS[n]["duckdb"]
        mapping = {d: d for d in VIEWS[n]["deps"]}
        parts.append(f"{n} AS ({string.Template(sql).substitute(mapping).strip()})")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


class Fixtures:
    """Spark side: base tables and derived views for one scale-factor folder."""

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.tag = uuid.uuid4().hex[:8]
        self.frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        key = (id(spark), sf_dir.rstrip("/"))
        fx = cls._cache.get(key)
        if fx is None:
            fx = cls._cache[key] = cls(spark, sf_dir)
        return fx

    def table(self, name: str) -> DataFrame:
        if name not in self.frames:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                spec = VIEWS[name]
                mapping = {d: self._view_name(d) for d in spec["deps"]}
                for d in spec["deps"]:
                    self.table(d)
                df = self.spark.sql(string.Template(spec["spark"]).substitute(mapping))
            df.createOrReplaceTempView(self._view_name(name))
            self.frames[name] = df
        return self.frames[name]

    def _view_name(self, name: str) -> str:
        return f"rf_{self.tag}_{name}"

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES or name in VIEWS:
            return self.table(name)
        raise AttributeError(name)
