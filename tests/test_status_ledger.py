"""The merged status table against a dictionary, the segmented ledger against a set."""
import random

from pyspark.sql import functions as F

from recflow.operators import ingest
from recflow.operators.status import StatusTable
from recflow.sources.ledger import Ledger

SCHEMA = "recording_id string, status string, category string, note string"


def state(df):
    return {r["recording_id"]: (r["status"], r["category"], r["note"]) for r in df.collect()}


def test_status_equals_a_dictionary(spark, tmp_path):
    rng, want = random.Random(8), {}
    table = StatusTable(spark, str(tmp_path), SCHEMA)
    assert state(table.read()) == {} and state(table.pending()) == {}
    for seq in range(9):
        columns = ["status", "category", "note"] if seq % 3 == 0 else rng.sample(["status", "category", "note"], rng.randrange(1, 3))
        keys = [f"k{k}" for k in range(60)] if seq == 0 else [f"k{k + 60 * (seq % 3 == 0)}" for k in rng.sample(range(60), 25)]
        rows = [(k, *(rng.choice([None, "enriched", "routed", "untriaged"]) if c == "status" else rng.choice([None, "a", "b"])
                      for c in columns)) for k in keys]
        if seq % 3:
            rows = [r for r in rows if r[0] in want]
        df = spark.createDataFrame(rows, "recording_id string, " + ", ".join(f"{c} string" for c in columns))
        for r in rows:
            old = want.get(r[0], (None, None, None))
            new = dict(zip(("status", "category", "note"), old, strict=True)) | dict(zip(columns, r[1:], strict=True))
            want[r[0]] = tuple(new.values())
        table.patch(df, seq)
        if seq == 4:
            table.patch(df, seq)  # replayed: replaces itself
        assert state(table.read()) == want
        assert state(table.pending()) == {k: v for k, v in want.items() if v[0] != "enriched"}
        if seq in (2, 3, 6):
            table.compact()
            assert state(table.read()) == want
    table.compact()
    assert state(table.pending()) == {k: v for k, v in want.items() if v[0] != "enriched"}


def test_pending_skips_settled_documents(spark, tmp_path):
    table = StatusTable(spark, str(tmp_path), SCHEMA)
    table.patch(spark.range(50).select(F.col("id").cast("string").alias("recording_id"), F.when(F.col("id") < 40, "enriched").otherwise("routed").alias("status"),
                                       F.lit("a").alias("category"), F.lit("n").alias("note")), 1)
    table.compact()
    assert len(state(table.pending())) == 10
    p = table.pending()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [open" in p or "isnotnull(open" in p


def test_ledger_equals_a_set(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "recording_id string")
    assert ledger.unseen(frame(["a"])).count() == 1 and ledger.may_hold(frame(["a"])) == []
    held = {}
    for seg in range(6):
        held[seg] = [f"id{seg}-{k}" for k in range(200 + 40 * seg)]
        ledger.append(frame([*held[seg], held[seg][0], None]), seg)
    ledger.append(frame(held[3]), 3)  # replayed
    # a batch that repeats ids of one segment reads that segment
    assert ledger.may_hold(frame(held[2][:20] + [f"new{k}" for k in range(500)])) == [2]
    batch = frame(held[1][:3] + held[5][-2:] + ["new", "new"])
    read = {f.split("seg=")[1].split("/")[0] for f in ledger.candidates(batch).inputFiles()}
    assert read == {"1", "5"}
    assert sorted(r[0] for r in ledger.unseen(batch).collect()) == ["new", "new"]
    assert ledger.may_hold(frame([f"foreign{k}" for k in range(3000)])) == []  # no false skip, next to no false read
    ledger.compact(fan=3)
    assert len(ledger.segments()) < 6
    everything = {i for x in held.values() for i in x}
    assert {r[0] for r in ledger.ids().collect()} == everything
    assert ledger.unseen(frame(sorted(everything)[::7])).count() == 0


def test_discovery_window_holds_its_edge_days(spark):
    days = ["2024-03-30", "2024-03-31", "2024-04-01", "2024-04-02", "2024-04-03", None]
    df = spark.createDataFrame([(d,) for d in days], "day string")
    assert [r[0] for r in ingest.discovery_window(df, "day", "2024-04-02", 2).collect()] == days[1:4]


def test_the_scorer_needs_no_package_on_the_workers(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from recflow.operators.reclassify import keyword_scorer

    (tmp_path / "f").write_bytes(cloudpickle.dumps(keyword_scorer))
    code = "import pickle, pandas as pd; print(pickle.load(open('f', 'rb'))(pd.Series(['a lecture']))['raw'][0])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin"})
    assert "Learning" in out.stdout, out.stderr
