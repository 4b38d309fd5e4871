"""The model stage in the stream: nothing asked twice, budgets, failed calls, bounded reads."""
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.streaming import model as M
from recflow.streaming import stages as S

DOCS = S.DOCS_SCHEMA.replace(", batch_id long", "")


def put_docs(spark, root, batch_id, rows):
    """rows: (recording_id, summary); returns the routed rows."""
    docs = [(i, i, "a note", "", "", "untriaged", text, "", "") for i, text in rows]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{root}/docs/batch_id={batch_id}")
    return spark.createDataFrame([(i, False, batch_id, batch_id, vocab.FALLBACK_CATEGORY) for i, _ in rows], S.ROUTED_SCHEMA)


def stage(root, **options):
    calls = f"{root}/calls.txt"

    def scorer(prompts):
        if prompts.str.contains("fails").any():  # no answer to any of them: they are asked one by one
            raise ValueError("no answer")
        with open(calls, "a") as out:
            out.writelines(p.rsplit("\n", 1)[1] + "\n" for p in prompts)
        raw = prompts.map(lambda p: "[1]" if "garbled" in p else '{"category": "Learning", "confidence": 0.5, "reason": "r"}')
        return pd.DataFrame({"raw": raw, "cache_read": 1, "cache_create": 0})

    open(calls, "w").close()
    return M.ModelStage(f"{root}/model", f"{root}/docs", "m", "now", scorer=scorer, **options)


def asked(root):
    return sorted(open(f"{root}/calls.txt").read().split("\n")[:-1])


def ids(spark, path):
    return sorted(r["recording_id"] for r in S.read_or_empty(spark, path, "recording_id string").collect())


def test_a_killed_batch_asks_nothing_twice(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    routed, s = put_docs(spark, root, 0, [("a", "one"), ("b", "two"), ("c", "one")]), stage(root)

    def killed(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(M.R, "verdict_decode", killed)  # the replies are written by then
        with pytest.raises(RuntimeError):
            M.reclass_batch(routed, 0, s)
    assert asked(root) == ["one", "two"]
    for _ in range(2):
        M.reclass_batch(routed, 0, s)
    assert asked(root) == ["one", "two"]  # one prompt for two documents, one call
    assert ids(spark, f"{root}/model/verdicts") == ["a", "b", "c"]
    # a prompt that comes again in a later batch takes the old reply
    later = put_docs(spark, root, 1, [("d", "two"), ("e", "three")])
    M.reclass_batch(later, 1, s)
    assert asked(root) == ["one", "three", "two"]
    got = M.verdicts_on(spark, f"{root}/model", later)
    assert sorted((r["recording_id"], r["category"], r["llm"]["model"]) for r in got.collect()) == [("d", "Learning", "m"), ("e", "Learning", "m")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(docs_batch#\d+L?\), \(docs_batch#\d+L? = 1\)\]", plan), plan
    assert spark.read.parquet(f"{root}/model/calls/batch_id=1").first()["calls"] == 3


def test_budgets_carry_over_and_nothing_is_dropped(spark, tmp_path):
    root = str(tmp_path)
    s = stage(root, per_batch=2, calls=5)
    M.reclass_batch(put_docs(spark, root, 0, [(f"a{k}", f"a{k}") for k in range(3)]), 0, s)
    assert asked(root) == ["a0", "a1"] and ids(spark, f"{root}/model/open/batch_id=0") == ["a2"]
    M.reclass_batch(put_docs(spark, root, 1, [(f"b{k}", f"b{k}") for k in range(2)]), 1, s)
    assert asked(root) == ["a0", "a1", "a2", "b0"]  # the oldest first
    none = put_docs(spark, root, 2, [("c", "c")])
    M.reclass_batch(none, 2, s)
    assert asked(root)[-1] == "b1" and ids(spark, f"{root}/model/open/batch_id=2") == ["c"]
    M.reclass_batch(none.limit(0), 3, s)  # all calls are made: the document stays open
    assert len(asked(root)) == 5 and ids(spark, f"{root}/model/open/batch_id=3") == ["c"]
    M.reclass_batch(none.limit(0), 4, M.ModelStage(**{**vars(s), "calls": None}))
    assert len(asked(root)) == 6 and ids(spark, f"{root}/model/open/batch_id=4") == []
    assert ids(spark, f"{root}/model/verdicts") == ["a0", "a1", "a2", "b0", "b1", "c"]


def test_failed_calls_and_unreadable_replies_stay_open(spark, tmp_path):
    root = str(tmp_path)
    s = stage(root)
    M.reclass_batch(put_docs(spark, root, 0, [("x", "fails"), ("y", "garbled"), ("z", "fine"), ("n", None)]), 0, s)
    assert ids(spark, f"{root}/model/verdicts") == ["n", "z"]
    assert ids(spark, f"{root}/model/open/batch_id=0") == ["x", "y"]
    empty = spark.createDataFrame([], S.ROUTED_SCHEMA)
    M.reclass_batch(empty, 1, s)  # asked again, as no usable reply is known
    assert asked(root).count("garbled") == 2 and asked(root).count("fine") == 1
    assert ids(spark, f"{root}/model/open/batch_id=1") == ["x", "y"]
    M.reclass_batch(empty, 2, M.ModelStage(f"{root}/model", f"{root}/docs", "m", "now"))  # no scorer: nothing is asked
    assert ids(spark, f"{root}/model/open/batch_id=2") == ["x", "y"]


def test_route_completes_its_own_batch_only(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([("a", "team meeting"), ("b", "note")], "recording_id string, name string").withColumn("batch_id", F.lit(7))
    for _ in range(2):
        S.route_batch(docs, 3, root)
    S.route_batch(docs.limit(0), 4, root)
    rows = spark.read.schema(S.ROUTED_SCHEMA).parquet(root).collect()
    assert sorted((r["recording_id"], r["category"], r["docs_batch"], r["batch_id"]) for r in rows) == [
        ("a", "Business", 7, 3), ("b", vocab.FALLBACK_CATEGORY, 7, 3)]
