"""A full cycle over the derived tables: stage counts are consistent, the model is asked
once for each document, and what it said is kept."""
import os

import pandas as pd

from recflow.functions import vocab
from conftest import SF_SMALL
from recflow.plans.common import RUN_DATE, RUN_TS, fx
from recflow.plans.cycle import counts_row, run_cycle


def test_full_cycle(spark, tmp_path):
    calls = str(tmp_path)

    def scorer(prompts):
        import os
        import uuid

        with open(os.path.join(calls, uuid.uuid4().hex), "w") as f:
            f.write(str(len(prompts)))
        cat = ["Finance" if i == 0 else "Learning" for i in range(len(prompts))]
        raw = ['{"category": "%s", "confidence": 0.6, "reason": "r"}' % c for c in cat]
        return pd.DataFrame({"raw": raw, "cache_read": 1, "cache_create": 0})

    out = run_cycle(spark, fx(spark, SF_SMALL), RUN_DATE, RUN_TS, scorer=scorer)
    pulls = counts_row(out["pull_counts"])
    routed = {r["category"]: r["n_docs"] for r in out["route_counts"].collect()}
    reclass = sum(r["n_verdicts"] for r in out["reclass_counts"].collect())
    enrich = counts_row(out["enrich_counts"])
    assert pulls["pulled"] > 0 and pulls["skipped"] > 0 and pulls["failed"] > 0
    assert sum(routed.values()) == pulls["pulled"]
    assert reclass > 0
    final = out["status"].read()
    in_buckets = final.where(final.category.isin(vocab.BUCKETS)).count()
    assert enrich["enriched"] + enrich["skipped"] == in_buckets < pulls["pulled"]  # "Finance" is no bucket
    named = final.where("llm IS NOT NULL").select("llm.*").collect()
    assert len(named) == reclass and all(r["model"] == "scorer" and r["reason"] for r in named)
    assert enrich["entity_hits"] > 0 and enrich["action_rollups"] > 0
    assert spark.read.parquet(out["sinks"]["backlinks"]).count() > 0
    asked = sum(int(open(os.path.join(calls, f)).read()) for f in os.listdir(calls))
    assert asked == reclass


def test_runs_repeat_on_one_root(spark):
    """A second run pulls, asks and enriches nothing; a document new in between is the only
    one that the third touches; a run lost before its end is done again with the same result."""
    from types import SimpleNamespace

    whole = fx(spark, SF_SMALL)
    names = ("recordings", "metadata", "transcripts", "listing", "ledger", "inbox", "summaries", "entities_src")
    parts = {n: getattr(whole, n).cache() for n in names}
    first = out = run_cycle(spark, SimpleNamespace(**parts), RUN_DATE, RUN_TS)
    ids = {r["recording_id"]: r for r in out["status"].read().collect()}
    late = sorted(ids)[3]
    root = run_cycle(spark, SimpleNamespace(**parts | {"listing": parts["listing"].where(~parts["listing"].value.contains(late))}),
                     RUN_DATE, RUN_TS, compact_every=1)["root"]
    before = {r["recording_id"]: r for r in run_cycle(spark, SimpleNamespace(**parts | {"listing": parts["listing"].where("false")}),
                                                      RUN_DATE, RUN_TS, root=root)["status"].read().collect()}
    assert set(before) == set(ids) - {late}
    lines = {n: spark.read.parquet(f"{root}/sinks/{n}").count() for n in ("backlinks", "rollups", "candidates")}
    second = run_cycle(spark, SimpleNamespace(**parts | {"listing": parts["listing"].where(~parts["listing"].value.contains(late))}),
                       RUN_DATE, "2031-01-01T00:00:00", root=root)
    assert counts_row(second["pull_counts"])["pulled"] == 0 and counts_row(second["enrich_counts"])["enriched"] == 0
    assert second["reclass_counts"].collect() == []
    assert {n: spark.read.parquet(f"{root}/sinks/{n}").count() for n in lines} == lines
    for again in range(2):  # the second time as if the run had been lost before its marker
        third = run_cycle(spark, SimpleNamespace(**parts), RUN_DATE, "2031-01-02T00:00:00", root=root)
        assert third["run"] == 3 and counts_row(third["pull_counts"])["pulled"] == 1
        now = {r["recording_id"]: r for r in third["status"].read().collect()}
        assert set(now) == set(ids) and {k: r for k, r in now.items() if k != late} == before
        assert counts_row(third["enrich_counts"])["enriched"] == 1
        if again == 0:
            from recflow.sources.ledger import remove
            remove(spark, f"{root}/runs/run=3")
    same = lambda r: {c: v for c, v in r.asDict().items() if c not in ("run", "enriched_at", "llm")}
    assert same(now[late]) == same(ids[late]) and first["run"] == 0
    for n in lines:
        assert sorted(spark.read.parquet(f"{root}/sinks/{n}").drop("recorded_date").collect()) == sorted(
            spark.read.parquet(first["sinks"][n]).drop("recorded_date").collect())
