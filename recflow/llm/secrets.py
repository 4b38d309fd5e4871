"""Secret scans with corpus-wide ownership frequency.

Detectors find candidate spans in each whole text.  The hash of each candidate's value is
counted over distinct repositories and owners: a value that several owners share, or that one
owner has copied to many repositories, is a widely copied example; one that a single owner
holds in few repositories may be live.  The base kinds (assign,
access, hex) are always reported; the further kinds are reported where they look live.

Only DataFrame functions are used.  A match's place is the running sum of the lengths of
the text between matches, over rows of one document; values are aggregated by owner and
repository before owners are counted, so that a value in a third of all rows stays small.
Defined results: null text counts as empty; a null owner or repository is one unknown one;
rows that repeat an id are scanned each by itself; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import stored, text_of


@dataclass(frozen=True)
class Detector:
    kind: str
    pattern: str
    group: int = 0
    least: int = 1  # characters of the value
    base: bool = False
    needs: tuple[str, ...] = ()  # patterns that the value has to hold


# The base kinds; hex and access have their least lengths in the pattern, as runs are maximal.
BASE = (
    Detector("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Detector("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Detector("hex", r"[0-9a-f]{16,}", base=True),
)
#: Further kinds that the frequency decides on.
FURTHER = (
    # to the END line, header lines and escaped line ends included; without one as far as headers and base64 go
    Detector("private_key", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----((?:[^-]++|-(?!----))*+(?=-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----)"
             r"|(?:\s*+[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+)*+[A-Za-z0-9+/=\s]*+)(?:-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----)?", 1),
    Detector("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Detector("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]*+:([^\s:/@]{4,}+)@", 1),
    Detector("opaque", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+", needs=("[0-9]", "[a-z]", "[A-Z]")),
)
#: A value held by more owners than this is an example.
MAX_OWNERS = 1
#: A value in more repositories than this is boilerplate, even of one owner.
MAX_REPOS = 3
#: Different characters that a live-looking value has at least.
LEAST_VARIETY = 6


def _hits(text: Column, number: int, d: Detector) -> Column:
    """Array of (kind_no, at, gap, size, value): gap characters lie between a match and the one before it."""
    pattern = F.lit(d.pattern)
    found = F.when(text.rlike(d.pattern), F.transform(
        F.arrays_zip(F.split(text, d.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)),
                     F.regexp_extract_all(text, pattern, F.lit(d.group))),
        lambda x, i: F.struct(F.lit(number).alias("kind_no"), i.alias("at"), F.length(x["0"]).alias("gap"),
                              F.length(x["1"]).alias("size"), x["2"].alias("value"))))
    # the text after the last match has no match beside it
    kept = F.filter(found, lambda x: x["size"].isNotNull())
    return F.coalesce(kept, F.array().cast("array<struct<kind_no:int,at:int,gap:int,size:int,value:string>>"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_cols: tuple[str, ...] = ("source", "lang"), detectors: tuple[Detector, ...] = BASE + FURTHER) -> tuple[DataFrame, DataFrame]:
    """(documents: row, id; spans: row, owner, repo, kind_no, start, end, key, varied)."""
    unknown = F.lit("\0")
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(owner_col).cast("string"), unknown).alias("owner"),
                         F.concat_ws("\1", *(F.coalesce(F.col(c).cast("string"), unknown) for c in repo_cols)).alias("repo"),
                         text_of(text_col).alias("text"))
    hits = F.concat(*(_hits(F.col("text"), k, d) for k, d in enumerate(detectors)))
    scanned = stored(picked.select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repo", hits.alias("hits")), "scanned")
    each = scanned.where(F.size("hits") > 0).select("row", "owner", "repo", F.explode("hits").alias("h")).select("row", "owner", "repo", "h.*")
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "kind_no").orderBy("at"))
    least = F.element_at(F.array(*(F.lit(d.least) for d in detectors)), F.col("kind_no") + 1)
    spans = each.withColumn("end", end).where(F.length("value") >= least)
    for k, d in enumerate(detectors):
        for need in d.needs:
            spans = spans.where((F.col("kind_no") != k) | F.col("value").rlike(need))
    spans = (spans
             .select("row", "owner", "repo", "kind_no", (F.col("end") - F.col("size")).alias("start"), "end",
                     F.sha2("value", 256).alias("key"),
                     (F.size(F.array_distinct(F.split("value", ""))) >= LEAST_VARIETY).alias("varied")))
    return scanned.select("row", "id"), stored(spans, "spans")


def ownership(spans: DataFrame) -> DataFrame:
    """key, n_owners, n_repos: over distinct (owner, repository) pairs of each value's hash."""
    pairs = spans.groupBy("key", "owner", "repo").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("key", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("key").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_cols: tuple[str, ...] = ("source", "lang"), detectors: tuple[Detector, ...] = BASE + FURTHER,
         max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """A row per document: id and ``found``, its spans (start, kind_no, end, base, live) in order."""
    documents, spans = find(docs, id_col, text_col, owner_col, repo_cols, detectors)
    held = stored(ownership(spans), "ownership")
    is_base = F.element_at(F.array(*(F.lit(d.base) for d in detectors)), F.col("kind_no") + 1)
    judged = (spans.join(held, "key").withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos) & F.col("varied"))
              .withColumn("base", is_base).where("base OR live"))
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "base", "live"))).alias("found"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,base:boolean,live:boolean>>")
    return documents.join(by_row, "row", "left").select("id", F.coalesce("found", none).alias("found"))


def joined(found: Column, detectors: tuple[Detector, ...] = BASE + FURTHER) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(d.kind) for d in detectors))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind_no"] + 1), x["start"], x["end"])), ",")
