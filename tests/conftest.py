import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recflow.session import get_session
    s = get_session("local[8]", 8, app="recflow-tests")
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(autouse=True, scope="module")
def no_cached_tables(spark):
    """What a module's tests cache is not left in the plans that later modules look at."""
    yield
    spark.catalog.clearCache()
