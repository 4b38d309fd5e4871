"""Limits that no longer cut, verdict decoding against Python's own parser, entity keys,
scorer failures, stream replays."""
import json
import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from recflow import session
from recflow.functions import projections as P
from recflow.functions import vocab
from recflow.operators import entities as EN
from recflow.operators import ingest
from recflow.operators import reclassify as R
from recflow.operators import route
from recflow.plans.common import fx
from recflow.sources.documents import frontmatter_map
from recflow.streaming import stages as S


def test_distinct_ids_are_never_taken_for_copies(spark):
    """300,000 ids: some begin with the same 8 characters."""
    ids = spark.range(300_000).select(F.col("id").alias("pos"), F.md5(F.col("id").cast("string")).alias("recording_id"))
    none = spark.createDataFrame([], "recording_id string")
    out = ingest.pull_outcome(ids, none, none, ids.select("recording_id", F.lit(True).alias("meta_valid")), ids)
    assert out.groupBy("status").count().collect() == [("pulled", 300_000)]
    short = ingest.pull_outcome(ids, none, spark.createDataFrame([], "short_id string"),
                                ids.select("recording_id", F.lit(True).alias("meta_valid")), ids, by_short_id=True)
    assert short.where("status = 'skipped'").count() > 0  # the opt-in file-name test collides


def test_duplicate_metadata_gives_one_line(spark):
    meta = spark.createDataFrame([("x", True, "2024-01-01", "", "b"), ("x", False, "2024-05-01", "", "z"), ("x", True, "2024-02-01", "", "a")],
                                 "recording_id string, meta_valid boolean, start_at string, created_at string, name string")
    cands = spark.createDataFrame([(1, "x")], "pos long, recording_id string")
    none = spark.createDataFrame([], "recording_id string")
    assert ingest.pull_outcome(cands, none, none, meta, cands).collect() == [(1, "x", "pulled")]
    assert [r["name"] for r in ingest.one_per_recording(meta).collect()] == ["a"]


def test_limits_are_opt_in(spark):
    row = spark.createDataFrame([("s", "x" * 9000 + " Acme Corp shipped", "r" * 300)], "summary string, transcript string, reason string")
    got = row.select(F.length(P.search_text("summary", "transcript")).alias("a"),
                     F.length(P.search_text("summary", "transcript", vocab.SEARCH_TRANSCRIPT_CHARS)).alias("b"),
                     F.length(P.delivery_text("summary", "transcript")).alias("c"),
                     F.length(P.delivery_text("summary", "transcript", vocab.DELIVERY_TRANSCRIPT_CHARS)).alias("d"),
                     F.length(P.reason_clean("reason")).alias("e"), F.length(P.reason_clean("reason", vocab.REASON_MAX_CHARS)).alias("f"),
                     F.length(P.summary_excerpt("transcript")).alias("g"),
                     F.length(P.summary_excerpt("transcript", vocab.SUMMARY_EXCERPT_CHARS)).alias("h")).first()
    assert tuple(got) == (9021, 8003, 9019, 4001, 300, 200, 9018, 1500)
    ents = spark.createDataFrame([("Acme Corp", "Companies", 2)], "name string, type string, type_rank int")
    docs = row.select(F.lit("d").alias("doc_key"), P.search_text("summary", "transcript").alias("text"))
    assert EN.entity_mentions(docs, ents).count() == 1  # behind 8,000 characters


def python_verdict(text):
    """The original's decoding: one JSON value or the substring tiers."""
    try:
        value = json.loads(text)
    except ValueError:
        named = next((c for c in vocab.VALID_CATEGORIES if c in text), None)
        return (2, named, 0.5) if named else (3, vocab.UNPARSEABLE_CATEGORY, 0.0)
    try:
        category, confidence = value["category"], float(value.get("confidence", 0))
        assert isinstance(category, str)
    except Exception:
        return (1, None, None)
    return (1, category, confidence)


REPLIES = ['{"category": "Casual", "confidence": 0.9}]', '{"category": "Casual", "confidence": 0.9}], [1',
           '{"category": "Casual", "confidence": "1.0d"}', '{"category": "Casual", "confidence": "0x1p3"}',
           '{"category": "Learning", "category": "Casual", "confidence": 0.9}', '{"category": "Casual", "confidence": NaN}',
           '{"category": "Casual", "confidence": -Infinity}', '{"category": "Casual", "confidence": "nan"}',
           '{"category": "Casual", "confidence": " 1_0.5e1 "}', '{"category": "Casual", "confidence": true}',
           '{"category": "Casual"}}', '{"category": "Casual"} tail', '{"category": "Casual"', "{'category': 'Casual'}",
           '{"category": 3}', '{}', '[]', '"Casual"', 'null', '1', '', 'Business or Learning', 'nothing', '[{"category": "Casual"}]',
           '{"category": "Casual"}, "v": {"category": "Learning"}', '{"category": "Casual", "confidence": null}',
           '{"category": "Casual", "confidence": [1]}', '{"category": "Casual", "confidence": "1__0"}']


def test_verdicts_equal_python(spark):
    rows = spark.createDataFrame(list(enumerate(REPLIES)), "i long, raw string")
    for r in R.verdict_decode(rows).select("i", "raw", "tier", "category", "confidence", "error").collect():
        tier, category, confidence = python_verdict(r["raw"])
        assert r["tier"] == tier, r
        assert (r["error"] is None) == (category is not None), r
        if category is not None:
            assert r["category"] == category, r
            same = r["confidence"] == confidence or (math.isnan(confidence) and math.isnan(r["confidence"]))
            assert same, r


def test_shared_last_words_are_no_keys(spark):
    n = 400
    docs = spark.createDataFrame([(str(k), f"we met Firm{k} Holdings Ltd today") for k in range(n)], "doc_key string, text string")
    ents = spark.createDataFrame([(f"Firm{k} Holdings Ltd", "Companies", 2) for k in range(n)], "name string, type string, type_rank int")
    words = EN.name_words(ents)
    assert EN.candidate_places(EN.word_index(docs, words), words).count() <= 2 * n
    assert EN.entity_mentions(docs, ents).count() == n


def test_mentions_equal_python_re(spark):
    alphabet = ["a", "b", "A", "é", "É", "ſ", "s", "K", "k", " ", "-", "(", ")", "+", "_", "1", "\n", "x"]
    names = ["ab", "Ab ba", "a(b)", "s-k", "ab+", "(x)", "é1", "b_a", "K1", "+", "a b", "--", "+(", "a a"]
    rng = random.Random(11)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(1500)]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_key string, text string")
    ents = spark.createDataFrame([(n, "People", 1) for n in names], "name string, type string, type_rank int")
    got = {(int(r["doc_key"]), r["name"]) for r in EN.entity_mentions(docs, ents).collect()}
    want = {(i, n) for i, t in enumerate(texts) for n in names if re.search(r"\b" + re.escape(n) + r"\b", t, re.I)}
    assert got == want and len(want) > 300


def test_many_symbol_only_names(spark):
    names = [("+" * k + "#" * j, "People", 1) for k in range(1, 40) for j in range(1, 40)]
    docs = spark.createDataFrame([("d", "a+++##b and c++d")], "doc_key string, text string")
    ents = spark.createDataFrame(names, "name string, type string, type_rank int")
    assert [r["name"] for r in EN.entity_mentions(docs, ents).collect()] == ["+++##"]


def test_a_failing_document_leaves_the_others_scored(spark):
    def scorer(prompts):
        if prompts.str.contains("bad").any():
            raise ValueError("no answer")
        return pd.DataFrame({"raw": ['{"category": "Casual"}'] * len(prompts), "cache_read": 0, "cache_create": 0})

    docs = spark.createDataFrame([(str(k), "bad" if k == 3 else "good") for k in range(6)], "doc_key string, prompt string")
    for kw in ({"scorer": scorer}, {"scorer": None, "factory": lambda: scorer}):
        got = {r["doc_key"]: r for r in R.verdict_decode(R.classify_model(docs, **kw)).collect()}
        assert got["3"]["error"] == "ValueError: no answer"
        assert all(r["category"] == "Casual" and r["error"] is None for k, r in got.items() if k != "3")


def test_header_map_keeps_the_last_of_a_key(spark):
    df = spark.createDataFrame([("---\na: 1\nb: 2\na: 3\n---\n",), ("no header",)], "text string")
    assert [r[0] for r in df.select(frontmatter_map("text")).collect()] == [{"b": "2", "a": "3"}, {}]


def test_bundles_by_directory_first_document_wins(spark):
    docs = spark.createDataFrame([("d", "a"), ("d", "a-b"), ("e", "a")], "directory string, stem string")
    files = spark.createDataFrame([("d", "a.md"), ("d", "a-b.md"), ("d", "a-b.txt"), ("d", "ab.md"), ("e", "a-b.md"), ("f", "a.md")],
                                  "directory string, file_name string")
    got = {(r["directory"], r["file_name"]): r["stem"] for r in route.sibling_bundle(docs, files).collect()}
    assert got == {("d", "a.md"): "a", ("d", "a-b.md"): "a-b", ("d", "a-b.txt"): "a-b", ("d", "ab.md"): "a", ("e", "a-b.md"): "a"}


def test_replayed_batches_write_nothing_twice(spark):
    root = session.shared_dir(spark, "replay")
    first = spark.createDataFrame([("a", "2024-01-05"), ("b", "2024-01-03")], "recording_id string, d string").selectExpr(
        "recording_id", "to_timestamp(d) AS recorded_at")
    second = spark.createDataFrame([("a", "2024-01-05"), ("c", "2023-01-01")], "recording_id string, d string").selectExpr(
        "recording_id", "to_timestamp(d) AS recorded_at")
    for batch, n in ((first, 0), (second, 1), (second, 1)):
        S.daily_counts_batch(batch, n, f"{root}/dedup", f"{root}/daily")
    rows = spark.read.parquet(f"{root}/dedup").select("recording_id", "late").collect()
    assert sorted(map(tuple, rows)) == [("a", False), ("b", False), ("c", True)]  # however late, it is kept
    assert spark.read.parquet(f"{root}/daily").agg(F.sum("n_recordings")).first()[0] == 3
    listing = spark.createDataFrame([("  " + "a" * 32 + " x",), ("  " + "b" * 32 + " y",)], "value string")
    t = S.IngestTables(root=f"{root}/t", metadata_path=f"{root}/meta", transcripts_path=f"{root}/tx", pulled_at="now")
    spark.createDataFrame([("a" * 32, "  name: n\n"), ("b" * 32, "  name: m\n")], "recording_id string, meta string").write.parquet(t.metadata_path)
    spark.createDataFrame([("a" * 32, "hello")], "recording_id string, transcript string").write.parquet(t.transcripts_path)
    for _ in range(2):
        S.ingest_batch(listing, 0, t)
    docs = spark.read.parquet(t.docs).collect()
    assert len(docs) == 1 and "hello" in docs[0]["text"]
    assert spark.read.parquet(f"{t.retry}/batch_id=0").collect()[0]["recording_id"] == "b" * 32


def test_late_rows_of_the_watermark_form(spark):
    batch = spark.sql("SELECT 'a' AS recording_id, TIMESTAMP'2024-01-01' AS recorded_at UNION ALL SELECT 'b', TIMESTAMP'2024-06-01'")
    import datetime
    assert [r["recording_id"] for r in S.late_rows(batch, datetime.datetime(2024, 6, 2), "90 days").collect()] == ["a"]


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_every_routing_keyword_is_hit(spark):
    keywords = {w for _, _, words in vocab.ROUTING_RULES for w in words}
    hit = {r["keyword"] for r in route.rule_hits(fx(spark, "/root/testdata/sf0.01").recordings).collect()}
    assert hit == keywords


def test_bucket_filter_excludes_rows(spark):
    from recflow.plans import route_plans as RT
    assert RT.q_bucket_union(spark, SF_SMALL).count() < fx(spark, SF_SMALL).recordings.count()
