"""Physical-plan checks: no nested loop for entity matching, pushed-down
partition filters, top-N as TakeOrderedAndProject, no Python outside the scorer."""
from conftest import SF_SMALL

from recflow.functions import vocab
from recflow.operators import reclassify as R
from recflow.plans import enrich_plans as EP
from recflow.plans import reclass_plans as RP
from recflow.plans import route_plans as RT
import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entity_mentions_has_no_nested_loop(spark):
    p = plan(EP._mentions(spark, SF_SMALL))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "BroadcastHashJoin" in p or "SortMergeJoin" in p


def test_reclass_budget_is_take_ordered_and_dealt_out(spark):
    docs = EP.edocs(spark, SF_SMALL)
    p = plan(R.reclass_batch(docs, vocab.DEFAULT_RECLASS_MAX))
    assert "TakeOrderedAndProject" in p and "REPARTITION_BY_NUM" in p
    assert "TakeOrdered" not in plan(RP.q_reclass_batch(spark, SF_SMALL))  # no budget unless asked for
    assert R.reclass_batch(docs, 50).count() == min(50, R.reclass_batch(docs).count())


def test_enrichment_reads_few_relations(spark):
    """Mentions and facts are written once; everything else reads these two."""
    run = EP._batch(spark, SF_SMALL)
    for df in (run.patches, run.counts, run.new_backlinks, run.new_candidates):
        assert plan(df).count("FileScan") <= 12
    assert plan(run.patches).count("FileScan") <= 4 and "documents.parquet" not in plan(run.patches)


def test_mentions_join_no_text(spark):
    p = plan(EP._mentions(spark, SF_SMALL))
    joins = [line for line in p.split("\n") if "Join" in line and "_key" in line]
    assert joins and not any("search_text" in line for line in joins)


def test_unclassified_scan_prunes_partitions(spark):
    p = plan(RT.q_unclassified_only(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(category" in p and "_unclassified" in p


def test_no_python_in_relational_plans(spark):
    qs = entry.queries()
    for k in ["entity_mentions", "action_items", "delivery_candidates", "verdict_decode", "pull_outcome",
              "frontmatter_map", "route_counts"]:
        p = plan(qs[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, k


def test_scorer_runs_in_map_in_pandas(spark):
    assert "MapInPandas" in plan(entry.queries()["classify_model"](spark, SF_SMALL))


def test_scan_columns_pruned(spark):
    p = plan(entry.queries()["route_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p  # the title quotes the text
