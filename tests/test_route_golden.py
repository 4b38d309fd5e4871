"""Routing rules: one case per rule, first-match order, whole words, dialect edges."""
import pytest

from recflow.operators import route

G_TITLES = [
    ("Dr appointment at 3pm", "Personal-Health", True),
    ("Patient onboarding meeting", "Personal-Health", True),   # health rule comes first
    ("Family catch-up", "Casual", True),
    ("Catch Up with Sam", "Casual", True),
    ("DATE NIGHT plans", "Casual", True),
    ("Spark training workshop", "Learning", False),
    ("Weekly STANDUP", "Business", False),
    ("Product demo pipeline", "Business", False),
    ("onsultation notes", "Business", False),
    ("OB review", "Personal-Health", True),
    ("Job ob_x list", "_unclassified", False),                 # OB inside a word
    ("projects and meetings", "_unclassified", False),         # plurals are other words
    ("gynecology follow-up", "_unclassified", False),
    ("visitation", "_unclassified", False),
    ("visit\u0301 notes", "Personal-Health", True),            # combining mark is not a word char
    ("x\u00e9OB", "_unclassified", False),                     # accented letter is a word char
    ("Memo", "_unclassified", False),
    ("", "_unclassified", False),
]


def test_classify_golden(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in G_TITLES], "title string")
    got = {r["title"]: (r["category"], r["sync_blocked"]) for r in route.classify_title(df).collect()}
    for title, cat, blocked in G_TITLES:
        assert got[title] == (cat, blocked), title


def test_null_title_falls_back(spark):
    df = spark.createDataFrame([(None,)], "title string")
    r = route.classify_title(df).collect()[0]
    assert (r["category"], r["sync_blocked"]) == ("_unclassified", False)


def test_rule_hits_counts_titles(spark):
    df = spark.createDataFrame([("visit visit",), ("Client review",), ("family visit",)], "title string")
    got = {(r["category"], r["keyword"]): r["n_titles"] for r in route.rule_hits(df).collect()}
    assert got[("Personal-Health", "visit")] == 2
    assert got[("Business", "client")] == 1 and got[("Business", "review")] == 1
    assert got[("Casual", "family")] == 1


def test_route_counts_every_bucket_nonempty(spark):
    from conftest import SF_SMALL
    from recflow.plans.common import fx
    counts = {r["category"]: r["n_docs"] for r in route.route_counts(
        route.classify_title(fx(spark, SF_SMALL).recordings)).collect()}
    assert set(counts) == {"Business", "Casual", "Learning", "Personal-Health", "_unclassified"}
    assert all(v > 0 for v in counts.values())


@pytest.mark.parametrize("files,stem,expected", [
    (["a.md", "a.summary.md", "a (x).md", "ab.md", "b.md"], "a", {"a.md", "a.summary.md", "a (x).md", "ab.md"}),
])
def test_sibling_bundle(spark, files, stem, expected):
    docs = spark.createDataFrame([("d", stem), ("d", "b")], "directory string, stem string")
    f = spark.createDataFrame([("d", x) for x in files], "directory string, file_name string")
    got = {r["file_name"] for r in route.sibling_bundle(docs, f).where("stem = 'a'").collect()}
    assert got == expected
