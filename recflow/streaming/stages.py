"""Structured Streaming versions of the stages.

The polling loop becomes a file-source stream with ``trigger(availableNow)``
(or a processing-time trigger); the checkpoint makes every file count once.
Each micro-batch runs the same batch functions inside ``foreachBatch`` and
writes idempotently: it has its own folder in a table, which a replay replaces,
or completes where a later stream reads the files; only lines of the enrichment
are anti-joined with what their days hold.  Tables and checkpoint belong together.

Tables live in a shared folder (under ``spark.checkpoint.dir``): ``ledger``
(ids in segments with Bloom sketches, one a batch), ``docs/batch_id=N`` (pulled
recordings with their unified document) and ``retry/batch_id=N``: the ids that are open
after batch N, one row each, of which only the last is read.  A batch reads of
the history only the ledger's segments that may hold one of its ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import doc_key
from recflow.operators import ingest
from recflow.operators.enrich import EnrichBatch
from recflow.operators.route import classify_title
from recflow.operators.sinks import unified_document
from recflow.operators.sketch import sketched
from recflow.sources.documents import path_exists
from recflow.session import TEXTS
from recflow.sources.ledger import Ledger
from recflow.sources.listing import listing_ids, metadata_fields

DOCS_SCHEMA = ("recording_id string, doc_key string, name string, start_at string, created_at string, "
               "status string, summary string, transcript string, text string, batch_id long")
ROUTED_SCHEMA = "recording_id string, sync_blocked boolean, docs_batch long, batch_id long, category string"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _only(history: DataFrame, rows: DataFrame, key: str = "recording_id") -> DataFrame:
    """The rows of a growing table whose ids the batch holds: where the batch's ids are
    few, AQE broadcasts them and the table is filtered where it is read."""
    return history.join(rows.select(key).distinct(), key, "left_semi")


def texts_near(history: DataFrame, ids: DataFrame, n_ids: int, key: str = "recording_id") -> DataFrame:
    """``_only`` for texts: those of other batches go by a sketch of the batch's ids where the
    table is read, so that they aren't shuffled; the few that pass go in the exact join."""
    # an inner join with the distinct ids: a semi join would be planned below the sketch
    return sketched(history, ids, key, n_ids).join(ids.select(key).distinct(), key)


def complete_batch(rows: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = (), key: str = "recording_id",
                   **options: str) -> None:
    """Add the rows to the folder of their batch, but for those that a lost attempt at the
    batch has left there: files that a later stream may have read stay.  No other batch is read."""
    folder = f"{path}/batch_id={batch_id}"
    held = read_or_empty(rows.sparkSession, folder, f"{key} string")
    rows.join(held, key, "left_anti").write.options(**options).mode("append").partitionBy(*by).parquet(folder)


def of_batches(spark: SparkSession, path: str, schema: str, numbers: DataFrame) -> DataFrame:
    """The rows of the batches whose numbers ``numbers`` (one column) holds.  The numbers, no
    more than a stream has had batches, become a filter on folders."""
    wanted = [r[0] for r in numbers.distinct().collect()]
    return read_or_empty(spark, path, schema).where(F.col("batch_id").isin(wanted))


@dataclass
class IngestTables:
    """Paths of the stream's state tables and lookup sources."""
    root: str
    metadata_path: str       # parquet (recording_id, meta)
    transcripts_path: str    # parquet (recording_id, transcript): grows as transcripts arrive
    summaries_path: str | None = None   # parquet (recording_id, summary)
    inbox_path: str | None = None   # parquet (recording_id)
    pulled_at: str = ""

    @property
    def ledger(self):
        return f"{self.root}/ledger"

    @property
    def docs(self):
        return f"{self.root}/docs"

    @property
    def retry(self):
        return f"{self.root}/retry"


def _last_before(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What the last batch before this one wrote."""
    for before in range(batch_id - 1, -1, -1):
        if path_exists(spark, f"{path}/batch_id={before}"):
            return spark.read.schema(schema).parquet(f"{path}/batch_id={before}")
    return spark.createDataFrame([], schema)


def ingest_batch(batch: DataFrame, batch_id: int, t: IngestTables) -> None:
    """One micro-batch of listing lines: gates, fetch, write docs, ledger, open retries."""
    spark = batch.sparkSession
    lines = batch.withColumn("pos", F.monotonically_increasing_id() + F.lit(batch_id) * F.lit(1 << 40))
    retry = _last_before(spark, t.retry, batch_id, "recording_id string, failed_batch long")
    # failed pulls of earlier batches come first, in their original order
    cands = (retry.select((F.col("failed_batch") - F.lit(1 << 20)).alias("pos"), "recording_id")
             .unionByName(listing_ids(lines)))
    ledger = Ledger(spark, t.ledger)
    ledger.compact(before=batch_id)
    known = ledger.candidates(cands, before=batch_id)
    meta = metadata_fields(spark.read.parquet(t.metadata_path))
    tx = spark.read.parquet(t.transcripts_path)
    sums = (spark.read.parquet(t.summaries_path) if t.summaries_path
            else spark.createDataFrame([], "recording_id string, summary string"))
    inbox = (spark.read.parquet(t.inbox_path) if t.inbox_path
             else spark.createDataFrame([], "recording_id string"))
    outcome = ingest.pull_outcome(cands, known, inbox, meta, tx).persist()
    try:
        pulled = outcome.where(F.col("status") == ingest.PULLED).select("recording_id").distinct()
        facts = ingest.one_per_recording(_only(meta.drop("meta"), pulled))
        n = pulled.count()
        docs = (pulled.join(facts, "recording_id").join(texts_near(tx.select("recording_id", "transcript"), pulled, n), "recording_id")
                .join(texts_near(sums.select("recording_id", "summary"), pulled, n), "recording_id", "left"))
        docs = docs.select("recording_id", doc_key("start_at", "created_at", "name", "recording_id").alias("doc_key"),
                           "name", "start_at", "created_at", F.lit(vocab.STATUS_UNTRIAGED).alias("status"),
                           "summary", "transcript", unified_document(docs, t.pulled_at).alias("text"))
        complete_batch(docs, t.docs, batch_id, **TEXTS)
        failed = (outcome.where(F.col("status") == ingest.FAILED).select("recording_id").distinct()
                  .join(retry, "recording_id", "left")
                  .select("recording_id", F.coalesce("failed_batch", F.lit(batch_id).cast("long")).alias("failed_batch")))
        failed.write.mode("overwrite").parquet(f"{t.retry}/batch_id={batch_id}")
        # a batch that is replayed doesn't count its own segment
        ledger.append(pulled, batch_id)
    finally:
        outcome.unpersist()


def start_ingest(spark: SparkSession, listing_dir: str, t: IngestTables, checkpoint: str,
                 available_now: bool = True, processing_time: str = "30 minutes"):
    """Start the ingest stream over a folder of listing text files."""
    src = spark.readStream.text(listing_dir)
    w = (src.writeStream.foreachBatch(lambda df, bid: ingest_batch(df, bid, t))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def route_batch(batch: DataFrame, batch_id: int, out_path: str) -> None:
    """Route newly pulled documents.  ``docs_batch`` is the batch that pulled a document:
    later stages read only the folders of such batches."""
    routed = classify_title(batch.withColumnRenamed("name", "title"))
    complete_batch(routed.select("recording_id", "category", "sync_blocked", F.col("batch_id").alias("docs_batch")),
                   out_path, batch_id, by=("category",))


def _over(spark: SparkSession, path: str, schema: str, checkpoint: str, each, only: Column | None = None):
    src = spark.readStream.schema(schema).parquet(path)
    src = src if only is None else src.where(only)
    return (src.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def start_route(spark: SparkSession, docs_path: str, out_path: str, checkpoint: str):
    """Route stage as a stream over the ingest stage's docs table."""
    return _over(spark, docs_path, DOCS_SCHEMA, checkpoint, lambda df, bid: route_batch(df, bid, out_path))


PATCHES_SCHEMA = ("recording_id string, status string, enriched_at string, entity_mentions string, "
                  "action_items_rollup string, vdc_candidate boolean, enriched_category string")
LINES = {"backlinks": "entity string, recording_id string, line string, recorded_date string",
         "rollups": "recording_id string, block string, recorded_date string",
         "candidates": "recording_id string, line string, recorded_date string"}


def enrich_stream_batch(batch: DataFrame, batch_id: int, docs_path: str, verdicts: DataFrame | None, entities: DataFrame,
                        root: str, run_date: str, at: str) -> None:
    """The whole enrichment of newly routed documents: mentions, action items, delivery
    candidates, link, block and queue lines, patches.  The category is the model's where it
    has given a verdict, else the route's.  The patches are written first: a replayed batch
    finds them and only completes the lines."""
    spark, key = batch.sparkSession, "recording_id"
    routed = batch.select(key, "category", "docs_batch")
    if verdicts is not None:
        given = verdicts.select(key, F.col("category").alias("_given"))
        routed = routed.join(given, key, "left").select(key, F.coalesce("_given", "category").alias("category"), "docs_batch")
    held = of_batches(spark, docs_path, DOCS_SCHEMA, routed.select("docs_batch")).withColumnRenamed("batch_id", "docs_batch")
    docs = routed.join(held, [key, "docs_batch"]).select(
        key, F.col("name").alias("title"), "category", "status", F.col("start_at").alias("recorded_at"), F.col("created_at").alias("uploaded_at"))
    old = {name: read_or_empty(spark, f"{root}/{name}", schema) for name, schema in LINES.items()}
    run = EnrichBatch(docs, _only(held, routed).select(key, "summary"), _only(held, routed).select(key, "transcript"), entities, run_date, at,
                      existing_backlinks=old["backlinks"], existing_blocks=old["rollups"],
                      existing_candidates=old["candidates"], key=key, categories=vocab.BUCKETS)
    complete_batch(run.patches, f"{root}/patches", batch_id)
    for name, new in (("backlinks", run.new_backlinks), ("rollups", run.new_blocks), ("candidates", run.new_candidates)):
        columns = [c.split()[0] for c in LINES[name].split(", ")]
        (new.select(*columns).hint("rebalance", "recorded_date").write.mode("append")
         .partitionBy("recorded_date").parquet(f"{root}/{name}"))


def start_enrich(spark: SparkSession, routed_path: str, docs_path: str, entities: DataFrame, root: str, checkpoint: str,
                 run_date: str, at: str, verdicts=None):
    """Enrichment as a stream over the routed documents.  ``verdicts(batch)`` gives the
    model's verdicts on a batch (see ``streaming.model``), to be run before this stream."""
    def each(df: DataFrame, bid: int) -> None:
        enrich_stream_batch(df, bid, docs_path, verdicts(df) if verdicts else None, entities, root, run_date, at)

    return _over(spark, routed_path, ROUTED_SCHEMA, checkpoint, each)


EVENTS_SCHEMA = "recording_id string, recorded_at timestamp, late boolean, overdue boolean"
#: Days that the recorder may hand in a recording late.
LATENESS_DAYS = 90


def _day(ts: str = "recorded_at") -> Column:
    return F.date_trunc("day", F.col(ts))


def dedup_batch(batch: DataFrame, batch_id: int, out_path: str, lateness_days: int = LATENESS_DAYS) -> DataFrame:
    """Exact dedup against all earlier batches, however old: the first arrival of an id is
    kept.  ``late``: older than the newest event of the batches before; ``overdue``: on a day
    that is as far before its day as the lateness allows or further, or on none.  Nothing is
    dropped.  Of the history a batch reads the segments of ids that may hold one of its own,
    and one row with the newest event.  Every batch writes its own folders, so a replay
    replaces what it wrote.  Returns the rows written."""
    spark = batch.sparkSession
    first = batch.groupBy("recording_id").agg(F.min("recorded_at").alias("recorded_at")).persist()
    try:
        ids = Ledger(spark, f"{out_path}-ids")
        ids.compact(before=batch_id)
        held = ids.candidates(first, before=batch_id)
        earlier = _last_before(spark, f"{out_path}-newest", batch_id, "newest timestamp")
        newest = earlier.agg(F.max("newest")).scalar()
        fresh = first.join(held.distinct(), "recording_id", "left_anti")
        overdue = _day() <= F.date_trunc("day", newest) - F.expr(f"INTERVAL {lateness_days} DAYS")
        path = f"{out_path}/batch_id={batch_id}"
        (fresh.select("recording_id", "recorded_at", F.coalesce(F.col("recorded_at") < newest, F.lit(False)).alias("late"),
                      F.coalesce(overdue, F.col("recorded_at").isNull()).alias("overdue"))
         .write.mode("overwrite").parquet(path))
        written = spark.read.schema(EVENTS_SCHEMA).parquet(path)
        (written.select(F.col("recorded_at").alias("newest")).unionByName(earlier).agg(F.max("newest").alias("newest"))
         .write.mode("overwrite").parquet(f"{out_path}-newest/batch_id={batch_id}"))
        ids.append(written, batch_id)
    finally:
        first.unpersist()
    return written


def daily_counts_batch(batch: DataFrame, batch_id: int, out_path: str, counts_path: str) -> None:
    """Day counts of the batch's deduplicated rows, in the batch's own folder."""
    fresh = dedup_batch(batch, batch_id, out_path)
    (fresh.groupBy(F.date_trunc("day", "recorded_at").alias("day_start")).agg(F.count(F.lit(1)).alias("n_recordings"))
     .write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}"))


def start_daily_counts(spark: SparkSession, events_path: str, counts_path: str, checkpoint: str,
                       lateness_days: int = LATENESS_DAYS):
    """Day counts of the deduplicated events as a stream with state: a row that comes within
    the lateness corrects its day, days behind the watermark leave the state.  Run it after
    the dedup's batch.  No row is lost: the watermark is never ahead of the bound that the
    dedup marks ``overdue`` by, and ``daily_counts`` adds the rows so marked."""
    src = spark.readStream.schema(EVENTS_SCHEMA).parquet(events_path)
    days = (src.where(~F.col("overdue")).select(_day().alias("day")).withWatermark("day", f"{lateness_days} days")
            .groupBy("day").agg(F.count(F.lit(1)).alias("n_recordings")))
    return (days.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, bid: upsert_days(df, bid, counts_path)).trigger(availableNow=True).start())


def upsert_days(days: DataFrame, batch_id: int, counts_path: str) -> None:
    """The days that a batch has changed, in its own folder: of a day the last batch's row counts."""
    days.write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}")


def daily_counts(spark: SparkSession, events_path: str, counts_path: str) -> DataFrame:
    """(day, n_recordings): every day's last count, and the overdue rows, which no state holds."""
    updates = read_or_empty(spark, counts_path, "day timestamp, n_recordings long, batch_id long")
    last = updates.groupBy("day").agg(F.max_by("n_recordings", "batch_id").alias("n_recordings"))
    overdue = read_or_empty(spark, events_path, EVENTS_SCHEMA).where("overdue").groupBy(_day().alias("day")).agg(F.count(F.lit(1)).alias("n_recordings"))
    return last.unionByName(overdue).groupBy("day").agg(F.sum("n_recordings").alias("n_recordings"))


def dedup_within_watermark(events: DataFrame, lateness: str, key: str = "recording_id", ts: str = "recorded_at") -> DataFrame:
    """Opt-in dedup with bounded state: ids seen within the lateness are dropped, and so is
    whatever is later than the watermark.  ``late_rows`` finds the latter for a side table."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def late_rows(batch: DataFrame, seen_max, lateness: str, ts: str = "recorded_at") -> DataFrame:
    """Rows of a raw micro-batch that a watermark at ``seen_max`` less the lateness drops;
    written to a side table from the same source, they complete the opt-in dedup."""
    return batch.where(F.col(ts) < F.lit(seen_max) - F.expr(f"INTERVAL {lateness}"))
