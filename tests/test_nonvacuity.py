"""Non-vacuity: the derived data exercise every branch of the main plans,
negatives included; and ingest run twice equals ingest once."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
import __spark_entry__ as entry
from recflow.operators import ingest
from recflow.plans import ingest_plans as IP
from recflow.plans.common import fx


def values(df, col):
    return {r[col] for r in df.select(col).distinct().collect()}


def test_pull_outcome_has_every_status(spark):
    assert values(entry.queries()["pull_outcome"](spark, SF_SMALL), "status") == {"pulled", "skipped", "failed"}


def test_ingest_twice_equals_once(spark):
    first = IP._outcome(spark, SF_SMALL)
    pulled = ingest.ledger_append(first)
    f = fx(spark, SF_SMALL)
    again = ingest.pull_outcome(IP._candidates(spark, SF_SMALL), f.ledger.unionByName(pulled), IP._inbox(spark, SF_SMALL),
                                IP._metadata(spark, SF_SMALL), IP._transcripts_by_id(spark, SF_SMALL))
    assert pulled.count() > 0
    assert again.where(F.col("status") == "pulled").count() == 0


def test_verdicts_cover_every_tier_and_error(spark):
    q = entry.queries()
    assert values(q["verdict_decode"](spark, SF_SMALL), "tier") == {1, 2, 3}
    assert values(q["verdict_decode"](spark, SF_SMALL), "valid_category") == {True, False}
    assert values(q["verdict_errors"](spark, SF_SMALL), "error") >= {"not an object", "no category"}


def test_mentions_cover_every_type_and_both_item_forms(spark):
    q = entry.queries()
    assert values(q["entity_mentions"](spark, SF_SMALL), "type") == {"People", "Companies", "Projects"}
    items = values(q["action_items"](spark, SF_SMALL), "item")
    assert any(i.startswith("Send the revised proposal") for i in items)      # heading form
    assert any(i.startswith("Call the vendor") for i in items)                # bullet-label form
    assert any(i.startswith("Book the venue") for i in items)                 # swallowed section
    assert not any("insert more" in i or i.endswith(":") for i in items)


def test_enrichment_sinks_and_flags_nonempty(spark):
    q = entry.queries()
    assert q["delivery_candidates"](spark, SF_SMALL).count() > 0
    assert q["delivery_queue"](spark, SF_SMALL).count() > 0
    patches = q["patch_enriched"](spark, SF_SMALL)
    assert values(patches, "vdc_candidate") == {True, None}
    assert patches.where("action_items_rollup IS NOT NULL").count() > 0
    assert patches.where("entity_mentions = '[]'").count() > 0
    assert values(patches, "status") == {"enriched", None}
    assert values(q["delivery_signal"](spark, SF_SMALL), "signal") == {True, False}


def test_reenrich_on_category_change(spark):
    from recflow.operators.enrich import enrich_pending
    df = spark.createDataFrame([("a", "enriched", "Business", "_unclassified"), ("b", "enriched", "Business", "Business"),
                                ("c", "routed", "Casual", None)],
                               "doc_key string, status string, category string, enriched_category string")
    assert {r["doc_key"] for r in enrich_pending(df).collect()} == {"c"}
    assert {r["doc_key"] for r in enrich_pending(df, reenrich_on_category_change=True).collect()} == {"a", "c"}
