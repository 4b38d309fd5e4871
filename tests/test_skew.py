"""Hot keys: one id filling a third of a listing, one entity in every document.
Results must stay whole and exact (no capping, no sampling)."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from recflow.operators import entities as EN
from recflow.operators import ingest
from recflow.plans import enrich_plans as EP
from recflow.plans import ingest_plans as IP
from recflow.plans.common import fx
from recflow.sources import listing as L


def test_hot_id_in_listing(spark):
    f = fx(spark, SF_SMALL)
    base = L.listing_ids(f.listing)
    n = base.count()
    hot_id = IP._outcome(spark, SF_SMALL).where("status = 'pulled'").orderBy("pos").first()["recording_id"]
    hot = spark.range(n // 2).select((F.col("id") * 8 + 7 + 10_000_000).alias("pos"), F.lit(hot_id).alias("recording_id"))
    cands = base.unionByName(hot)
    out = ingest.pull_outcome(cands, f.ledger, IP._inbox(spark, SF_SMALL), IP._metadata(spark, SF_SMALL),
                              IP._transcripts_by_id(spark, SF_SMALL))
    hot_rows = out.where(F.col("recording_id") == hot_id)
    assert hot_rows.count() == n // 2 + 1                                  # every line kept
    assert hot_rows.where("status = 'pulled'").count() == 1                # first copy only
    assert out.count() == cands.count()


def test_entity_in_every_document(spark):
    p = EP.prepared(spark, SF_SMALL).select("doc_key", F.concat("search_text", F.lit(" Red Widget.")).alias("text"))
    ents = spark.createDataFrame([("red widget", "Projects", 3)], "name string, type string, type_rank int")
    hits = EN.entity_mentions(p, ents)
    assert hits.count() == p.count()
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
