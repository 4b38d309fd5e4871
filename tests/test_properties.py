"""Property tests: generated inputs, one Spark job per property."""
import random

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recflow.functions.text import name_pattern
from recflow.operators import actions as A
from recflow.operators import entities as EN
from recflow.plans import enrich_plans as EP

ALPHABET = ["a", "b", "A", "B", "é", "É", "ſ", "s", "K", "k", "́", " ", "-", "(", ")", "+", "_",
            "1", "\n", " ", "x", "İ", "i", "ı"]
NAMES = ["ab", "Ab ba", "a(b)", "s-k", "ſa", "ab+", "(x)", "é1", "b_a", "K1", "iı", "+", "a b"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=40), min_size=50, max_size=120))
def test_token_join_equals_nested_loop(spark, texts):
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_key string, text string")
    ents = spark.createDataFrame([(n, "People", 1) for n in NAMES], "name string, type string, type_rank int")
    fast = {(r["doc_key"], r["name"]) for r in EN.entity_mentions(docs, ents).collect()}
    slow_plan = (docs.select("doc_key", F.col("text").alias("_text"))
                 .join(ents.select("name", name_pattern("name").alias("_pattern")), F.expr("_text RLIKE _pattern")))
    slow = {(r["doc_key"], r["name"]) for r in slow_plan.collect()}
    assert fast == slow


LINES = ["## Next Steps", "### Plan", "> ## Action Items", "## Notes", "---", "- Plan:", "- Next Step :",
         "- [ ] Call the supplier soon", "- [x] done item here", "* star item number", "- short",
         "- insert more", "- Owner:", "- @Dana Smith", "> - quoted bullet item", "1. numbered item",
         "plain prose line", "", "  - indented bullet item", "-\tTabbed bullet item", "## To-do list"]


def test_action_items_match_sql(spark):
    rnd = random.Random(7)
    docs = ["\n".join(rnd.choice(LINES) for _ in range(rnd.randint(0, 12))) + rnd.choice(["", "\n"])
            for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(docs)), "i long, s string")
    got = {r["i"]: list(r["items"]) for r in df.select("i", A.action_items("s").alias("items")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE prep (doc_key BIGINT, summary VARCHAR)")
    con.executemany("INSERT INTO prep VALUES (?, ?)", list(enumerate(docs)))
    a = EP._d_items("summary", EP._A)
    b = EP._d_items("summary", EP._B)
    want = dict(con.execute(f"SELECT doc_key, CASE WHEN len({a}) > 0 THEN {a} ELSE {b} END FROM prep").fetchall())
    assert sum(1 for v in got.values() if v) > 50
    for i in range(len(docs)):
        assert got[i] == list(want[i]), (i, docs[i])
