"""Idempotence (a second run appends nothing) and streaming == batch."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from recflow.operators import ingest
from recflow.plans import enrich_plans as EP
from recflow.plans import ingest_plans as IP
from recflow.plans import stream_plans as SP


def test_enrich_twice_appends_nothing(spark):
    first = EP._batch(spark, SF_SMALL)
    assert first.new_backlinks.count() > 0 and first.new_blocks.count() > 0 and first.new_candidates.count() > 0
    second = EP._batch(spark, SF_SMALL, previous=first)
    assert second.new_backlinks.count() == 0
    assert second.new_blocks.count() == 0
    assert second.new_candidates.count() == 0


def test_enrich_split_batches_equal_one_batch(spark):
    docs = EP.edocs(spark, SF_SMALL)
    one = {tuple(r) for r in EP._batch(spark, SF_SMALL, docs).new_backlinks.select("entity", "line").collect()}
    a = EP._batch(spark, SF_SMALL, docs.where(F.col("doc_id") % 2 == 0))
    b = EP._batch(spark, SF_SMALL, docs.where(F.col("doc_id") % 2 == 1), previous=a)
    two = {tuple(r) for r in a.new_backlinks.select("entity", "line").collect()} | \
          {tuple(r) for r in b.new_backlinks.select("entity", "line").collect()}
    assert one == two


def test_stream_ingest_equals_batch_and_retries(spark):
    _root, t = SP._run_ingest(spark, SF_SMALL)
    streamed = {r["recording_id"] for r in spark.read.parquet(t.docs).collect()}
    batch = {r["recording_id"] for r in ingest.ledger_append(IP._outcome(spark, SF_SMALL)).collect()}
    assert streamed == batch
    retry = spark.read.parquet(t.retry)
    retried = retry.join(spark.read.parquet(t.docs), "recording_id")
    assert retried.count() > 0          # failed first (late transcript), pulled on the next run
    assert retry.groupBy("batch_id", "recording_id").count().where("count > 1").count() == 0  # one open row per id
    assert spark.read.parquet(t.docs).groupBy("recording_id").count().where("count > 1").count() == 0


def test_stream_dedup_keeps_one_per_id(spark):
    rows = SP.q_stream_dedup(spark, SF_SMALL)
    assert rows.count() == rows.select("recording_id").distinct().count() > 0


def test_sinks_round_trip_and_prune_by_day(spark):
    from recflow.operators.sinks import write_enrich_sinks
    from recflow.session import shared_dir
    docs = EP.edocs(spark, SF_SMALL)
    first = EP._batch(spark, SF_SMALL, docs.where(F.col("doc_id") < 100))
    paths = write_enrich_sinks(first, shared_dir(spark, "sinks"))
    old = spark.read.parquet(paths["backlinks"])
    assert old.count() == first.new_backlinks.count() > 0
    later = EP.E.enrich_batch(docs, EP.esummaries(spark, SF_SMALL), EP.etranscripts(spark, SF_SMALL),
                              EP.entities(spark, SF_SMALL), EP.RUN_DATE, EP.ENRICH_TS,
                              existing_backlinks=old)
    plan = later.new_backlinks._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    got = {tuple(r) for r in later.new_backlinks.select("entity", "line").collect()}
    everything = {tuple(r) for r in EP._batch(spark, SF_SMALL, docs).new_backlinks.select("entity", "line").collect()}
    assert got == everything - {tuple(r) for r in old.select("entity", "line").collect()}
