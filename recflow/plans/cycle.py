"""The scheduled cycle: ingest -> route -> model reclassification -> enrich, again and again.

A run works on what the runs before left under one root: the ledger's segments, the texts
pulled (``docs/run=N``), the status table with its patches, and the sinks.  Documents go by
their recording id.  Every stage writes under the run's number and reads the state as the
stages before it left it, so a run that was lost on the way is done again with the same
result; a marker (``runs/run=N``) ends it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recflow.fixtures import Fixtures
from recflow.functions import projections as P
from recflow.functions import vocab
from recflow.operators import enrich as E
from recflow.operators import ingest
from recflow.operators import reclassify as R
from recflow.operators import route
from recflow.operators.entities import load_entities
from recflow.operators.status import StatusTable
from recflow.session import shared_dir, stored
from recflow.sources import listing as L
from recflow.sources.ledger import Ledger, folders
from recflow.streaming.stages import read_or_empty


#: Columns of the status table.
STATUS = ("recording_id string, run int, doc_key string, title string, recorded_at string, uploaded_at string, status string, "
          "category string, sync_blocked boolean, llm struct<model:string,confidence:double,reason:string,at:string>, "
          "enriched_at string, entity_mentions string, action_items_rollup string, vdc_candidate boolean, enriched_category string")
TEXTS = "recording_id string, summary string, transcript string, run int"
SINKS = {"backlinks": "entity string, recording_id string, line string, recorded_date string",
         "rollups": "recording_id string, block string, recorded_date string",
         "candidates": "recording_id string, line string, recorded_date string"}
#: Patches of a run, in order; runs between two snapshots of the status table.
PULL, ROUTE, MODEL, ENRICH = range(4)
COMPACT_EVERY = 8


def status_table(spark: SparkSession, root: str) -> StatusTable:
    """Open documents: those not enriched, and those still without a category or verdict."""
    unasked = (F.col("category") == vocab.FALLBACK_CATEGORY) & F.col("llm").isNull()
    todo = F.col("status").isNull() | (F.col("status") != vocab.STATUS_ENRICHED) | F.coalesce(unasked, F.lit(False))
    return StatusTable(spark, f"{root}/status", STATUS, is_open=todo)


def run_cycle(spark: SparkSession, fx: Fixtures, run_date: str, run_ts: str,
              scorer=R.keyword_scorer, max_reclass: int | None = None,
              root: str | None = None, compact_every: int = COMPACT_EVERY) -> dict:
    """One run over ``root``.  Returns the paths, the status table and the counts."""
    root = root or shared_dir(spark, "cycle")
    run = 1 + max((int(n.split("=")[1]) for n, whole in folders(spark, f"{root}/runs").items() if whole), default=-1)
    table, ledger = status_table(spark, root), Ledger(spark, f"{root}/ledger")
    number = lambda stage: run * 4 + stage
    rec = fx.recordings.select("doc_id", "recording_id")

    # ingest: gates, fetch (metadata + sidecars), documents, ledger
    meta = L.metadata_fields(fx.metadata)
    tx = fx.transcripts.join(rec, "doc_id")
    lines = L.listing_ids(fx.listing)
    known = fx.ledger.select("recording_id").unionByName(ledger.candidates(lines, before=run))
    outcome = stored(ingest.pull_outcome(lines, known, L.inbox_ids(fx.inbox), meta, tx), "outcome")
    pulled = ingest.ledger_append(outcome)
    docs = (pulled.join(ingest.one_per_recording(meta.drop("meta")), "recording_id").join(rec, "recording_id")
            .join(fx.summaries, "doc_id", "left").join(fx.transcripts, "doc_id", "left"))
    docs.select("recording_id", "summary", "transcript").write.mode("overwrite").parquet(f"{root}/docs/run={run}")
    kinds = {f.name: f.dataType for f in StructType.fromDDL(STATUS)}
    new = docs.select("recording_id", F.lit(run).alias("run"), P.doc_key("start_at", "created_at", "name", "recording_id").alias("doc_key"),
                      F.col("name").alias("title"), F.col("start_at").alias("recorded_at"), F.col("created_at").alias("uploaded_at"),
                      F.lit(vocab.STATUS_UNTRIAGED).alias("status"))
    new = new.select("*", *(F.lit(None).cast(t).alias(c) for c, t in kinds.items() if c not in new.columns))
    table.patch(new, number(PULL))
    ledger.append(pulled, run)

    # route: one projection
    untriaged = table.pending(before=number(ROUTE)).where(F.col("status") == vocab.STATUS_UNTRIAGED)
    routed = route.classify_title(untriaged.select("recording_id", "title"))
    table.patch(routed.select("recording_id", "category", "sync_blocked", F.lit(vocab.STATUS_ROUTED).alias("status")), number(ROUTE))

    # model stage: documents in the fallback bucket that have no verdict yet.  The replies are
    # written before they are decoded: a repeated run asks nothing twice
    texts = spark.read.schema(TEXTS).parquet(f"{root}/docs")

    def texts_of(documents: DataFrame) -> DataFrame:
        """Only the runs that pulled some of these documents are read."""
        return texts.join(documents.select("run", "recording_id"), ["run", "recording_id"], "left_semi")

    key = "recording_id"
    unsorted = stored(table.pending(before=number(MODEL)).where(F.col("llm").isNull()), "unsorted")
    asked = R.reclass_batch(unsorted, max_reclass, key)
    if not folders(spark, f"{root}/replies").get(f"run={run}"):
        batch = R.with_prompt(asked.join(texts_of(asked).select(key, "summary"), key, "left"))
        R.classify_model(batch, scorer, key).write.mode("overwrite").parquet(f"{root}/replies/run={run}")
    decoded = R.verdict_decode(spark.read.parquet(f"{root}/replies/run={run}"))
    patched = R.patch_reclassified(R.verdict_join(unsorted, decoded, key), "scorer", run_ts).where(F.col("llm").isNotNull())
    table.patch(patched.select(key, "category", "sync_blocked", "llm"), number(MODEL))

    # enrich what isn't enriched; the patch is kept as first written, as a repeated run finds
    # lines in the sinks that were new to it
    pending = stored(table.pending(before=number(ENRICH)), "pending")
    side = texts_of(E.enrich_pending(pending))
    old = {n: read_or_empty(spark, f"{root}/sinks/{n}", schema) for n, schema in SINKS.items()}
    result = E.enrich_batch(pending, side.select(key, "summary"), side.select(key, "transcript"), load_entities(fx.entities_src),
                            run_date, run_ts, existing_backlinks=old["backlinks"], existing_blocks=old["rollups"],
                            existing_candidates=old["candidates"], key=key, stem="doc_key", categories=vocab.BUCKETS)
    if not table.has(number(ENRICH)):
        table.patch(result.patches, number(ENRICH))
    counts = stored(result.counts, "enrich-counts")
    sinks = {}
    for name, rows in (("backlinks", result.new_backlinks), ("rollups", result.new_blocks), ("candidates", result.new_candidates)):
        sinks[name] = f"{root}/sinks/{name}"
        columns = [c.split()[0] for c in SINKS[name].split(", ")]
        rows.select(*columns).hint("rebalance", "recorded_date").write.mode("append").partitionBy("recorded_date").parquet(sinks[name])
    settled = (table.read(before=number(ENRICH)).where(F.col("category").isin(vocab.BUCKETS))
               .agg(F.count(F.lit(1))).scalar() - F.col("enriched"))
    counts = stored(counts.withColumn("skipped", settled), "counts")
    if run % compact_every == compact_every - 1:
        table.compact()
        ledger.compact()
    counts.write.mode("overwrite").parquet(f"{root}/runs/run={run}")
    return {
        "root": root, "run": run, "sinks": sinks, "status": table,
        "pull_counts": ingest.pull_counts(outcome),
        "route_counts": route.route_counts(table.read()),
        "reclass_counts": R.reclass_counts(decoded),
        "enrich_counts": counts,
    }


def counts_row(df: DataFrame) -> dict:
    return df.collect()[0].asDict()
