"""A sample of queries() against oracle_sql() on DuckDB at sf0.001 (the full
set runs at sf0.01 with tools/oracle_check.py)."""
import duckdb
import pytest

from conftest import SF_SMALL
from recflow.fixtures import BASE_TABLES
import __spark_entry__ as entry
from tools.oracle_check import digest

KEYS = ["route_counts", "classify_title", "pull_outcome", "unified_document", "metadata_fields",
        "entity_mentions", "action_items", "delivery_queue", "patch_enriched", "verdict_decode",
        "frontmatter_map", "section_extract", "sibling_bundle", "ledger_seed"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows) > 0
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 5 and df.columns == ["category", "n_docs"]


def test_every_sql_key_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
