"""Bounded reads of history, event-time counts, lateness."""
import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from recflow.sources.ledger import Ledger
from recflow.streaming import stages as S

SCHEMA = "recording_id string, recorded_at timestamp"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_days_are_corrected_within_the_lateness_and_nothing_is_lost(spark, tmp_path):
    rng = random.Random(4)
    start = dt.datetime(2025, 1, 1)
    drops, seen, want, overdue = [], set(), Counter(), set()
    newest = None
    for k in range(4):
        rows = [(f"r{rng.randrange(400)}", None) for _ in range(60)]
        rows = [(i, start + dt.timedelta(days=60 * k - rng.choice([0, 1, 5, 30, 89, 90, 91, 200]), hours=rng.randrange(24))) for i, _ in rows]
        rows += [(f"undated{k}", None)]
        first = {}
        for i, at in rows:
            first[i] = at if i not in first else min(first[i], at)
        for i, at in first.items():
            if i not in seen:
                seen.add(i)
                want[at.date() if at else None] += 1
                if at is None or newest and at.date() <= newest.date() - dt.timedelta(days=90):
                    overdue.add(i)
        newest = max([newest or start, *(at for i, at in first.items() if at and at)])
        drops.append(rows)
    root, held = str(tmp_path), []
    for k, rows in enumerate(drops):
        S.dedup_batch(frame(spark, rows), k, f"{root}/dedup")
        if k == 1:
            S.dedup_batch(frame(spark, rows), k, f"{root}/dedup")  # replayed before the counts read it
        q = S.start_daily_counts(spark, f"{root}/dedup", f"{root}/daily", f"{root}/checkpoint")
        q.awaitTermination()
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = {r["day"].date() if r["day"] else None: r["n_recordings"] for r in S.daily_counts(spark, f"{root}/dedup", f"{root}/daily").collect()}
    rows = spark.read.parquet(f"{root}/dedup").collect()
    kept_newest_matters = {r["recording_id"] for r in rows if r["overdue"]}
    assert len(rows) == len(seen) and sum(got.values()) == len(seen)
    assert got == dict(want)
    assert kept_newest_matters >= {f"undated{k}" for k in range(4)} and len(kept_newest_matters) > 10
    assert held[-1] < len(want) - 5  # days behind the watermark have left the state
    S.upsert_days(spark.read.parquet(f"{root}/daily/batch_id=0"), 10_000, f"{root}/other")  # a batch owns its folder
    assert S.read_or_empty(spark, f"{root}/nothing", "a long").count() == 0


def test_dedup_reads_only_segments_that_may_hold_its_ids(spark, tmp_path):
    root = str(tmp_path / "dedup")
    at = dt.datetime(2025, 3, 1)
    for k in range(5):
        S.dedup_batch(frame(spark, [(f"b{k}-{j}", at) for j in range(50)]), k, root)
    ids = Ledger(spark, f"{root}-ids")
    batch = frame(spark, [("b2-7", at), ("new", at)])
    assert ids.may_hold(batch, before=5) == [2]
    assert [r["recording_id"] for r in S.dedup_batch(batch, 5, root).collect()] == ["new"]
    files = ids.candidates(batch, before=5).inputFiles()
    assert files and all("seg=2/" in f for f in files)
    for k in range(6, 12):  # small segments are merged, ids stay known
        S.dedup_batch(frame(spark, [(f"b{k}-{j}", at) for j in range(50)]), k, root)
    assert len(ids.segments()) < 11
    every = frame(spark, [(f"b{k}-{j}", at) for k in range(5) for j in range(50)])
    assert S.dedup_batch(every, 12, root).count() == 0
    assert S.dedup_batch(every.limit(0), 13, root).count() == 0


def test_newest_event_is_one_row(spark, tmp_path):
    root = str(tmp_path / "dedup")
    S.dedup_batch(frame(spark, [("a", dt.datetime(2025, 6, 1))]), 0, root)
    S.dedup_batch(frame(spark, [("b", dt.datetime(2025, 3, 3)), ("c", dt.datetime(2025, 3, 4, 1)), ("d", None)]), 2, root)
    got = {r["recording_id"]: (r["late"], r["overdue"]) for r in spark.read.parquet(root).collect()}
    assert got == {"a": (False, False), "b": (True, True), "c": (True, False), "d": (False, True)}
    newest = spark.read.parquet(f"{root}-newest").where(F.col("batch_id") == 2).collect()
    assert [r["newest"] for r in newest] == [dt.datetime(2025, 6, 1)]
