"""Steps that must not grow faster than the input: how often texts move, what an index shuffles."""
import random
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from recflow.functions.text import NON_WORD, WORD
from recflow.operators import enrich as E
from recflow.operators import entities as EN
from recflow.operators.sketch import sketched
from recflow.plans import enrich_plans as EP
from recflow.plans import stream_plans as SP
from recflow.streaming import stages as ST


def _shuffled(df, column):
    """Exchanges whose rows hold the column, none of the tables being small enough to send."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return len(re.findall(rf"\) Exchange\nInput \[\d+\]: \[[^\n]*\b{column}#", plan))


def _sketch_first(spark, make, key):
    """Whether rows go by the sketch before they are shuffled for the exact join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    p = p[p.index("SortMergeJoin"):]
    return 0 <= p.find(f"Exchange hashpartitioning({key}") < p.find("BroadcastHashJoin")


def test_texts_move_once_to_their_documents(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = EP.prepared(spark, SF_SMALL)
        assert _shuffled(p, "summary") == 0
        assert _shuffled(p.select("doc_key", "summary"), "text") == 1  # of documents
        assert _shuffled(p.select("doc_key", "transcript"), "tail") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_ids_keep_their_rows(spark, tmp_path):
    """A table whose rows stand twice: each row finds each of its id's sidecars."""
    for name in ("documents", "supplier", "customer", "part", "conversations"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "documents":
            t = t.where("doc_id < 40").unionByName(t.where("doc_id in (8, 15)"))
            t = t.unionByName(t.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long")))
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    f = EP.fx(spark, str(tmp_path))
    counts = {r["doc_id"]: r["n"] for r in f.summaries.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts[8] == counts[15] == 2 and counts[7] == 1 and None not in counts
    kept = EP.prepared(spark, str(tmp_path)).groupBy("doc_key").count()
    assert sorted(r["count"] for r in kept.collect())[-2:] == [2 * 4 * 4] * 2


def test_sketch_drops_foreign_words_and_keeps_all_others(spark):
    keys = spark.range(0, 3000).select(F.concat(F.lit("K"), "id").alias("_key"))
    placed = spark.range(0, 30000).select(F.concat(F.lit("K"), "id").alias("_key"), F.col("id").alias("_no"))
    left = {r["_no"] for r in sketched(placed, keys, "_key", 3000).collect()}
    assert left >= set(range(3000)) and len(left) < 3000 + 27000 * 0.06


def test_large_dictionary_gives_the_same_index(spark, monkeypatch):
    docs = spark.createDataFrame([(str(i), f"met Ring {i} and W{i}-x, bolt") for i in range(50)], "doc_key string, text string")
    ents = spark.createDataFrame([(f"W{i}", "People", 1) for i in range(30)] + [("ring 7", "Projects", 3)],
                                 "name string, type string, type_rank int")

    def found():
        return {tuple(r) for r in EN.entity_mentions(docs, ents).collect()}

    small = found()
    monkeypatch.setattr(EN, "SENT_WORDS", 0)
    assert found() == small and len(small) == 31
    words = EN.name_words(ents)
    assert _sketch_first(spark, lambda: EN.word_index(docs, words), "_key")


def test_words_and_separators_equal_python_re(spark):
    rng = random.Random(1)
    chars = "ab Z9_é İſ ́\n\t.-#  …日"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(0, 40))) for _ in range(400)] + ["", "a", " a", "…a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    cut = [F.regexp_extract_all("text", F.lit(f"({NON_WORD}*)({WORD}+)"), k) for k in (1, 2)]
    want = {r["id"]: list(zip(r["pre"], r["part"])) for r in df.select("id", cut[0].alias("pre"), cut[1].alias("part")).collect()}
    got: dict = {}
    for r in EN._words_of(df, ["id"], "text").orderBy("id", "_no").collect():
        got.setdefault(r["id"], []).append((r["_pre"], r["_part"]))
    assert got == {i: x for i, x in want.items() if x}


def test_ingest_shuffles_only_texts_of_its_batch(spark):
    """Texts of other batches go before the joins that bring a batch's texts together."""
    texts = spark.range(0, 20000).select(F.md5(F.col("id").cast("string")).alias("recording_id"), F.lit("t").alias("transcript"))
    pulled = texts.where("recording_id < '04'").select("recording_id")
    n = pulled.count()
    near = sketched(texts, pulled, "recording_id", n)
    assert 0 < n <= near.count() < n + 20000 * 0.06
    assert ST.texts_near(texts, pulled, n).count() == n
    assert ST.texts_near(texts, pulled.where("false"), 0).count() == 0
    assert _sketch_first(spark, lambda: ST.texts_near(texts, pulled, n), "recording_id")


def test_a_run_joins_the_texts_once(spark, monkeypatch):
    made, real = [], E.stored
    monkeypatch.setattr(E, "stored", lambda df, name, **options: made.append(name) or real(df, name, **options))
    for ask, tables in ((lambda r: (r.counts, r.patches, r.new_backlinks, r.new_blocks), ["enrich-texts", "enrich-mentions"]),
                        (lambda r: r.new_candidates, ["enrich-texts", "enrich-companies"]),
                        (lambda r: r.new_blocks, ["enrich-facts"])):
        made.clear()
        ask(EP._batch(spark, SF_SMALL))
        assert made == tables


def test_repeated_keys_share_their_signal(spark):
    """A key with a signal in one of its texts: the companies of all its texts count."""
    docs = spark.createDataFrame([("a", "a", "Business", "routed", "2024-01-01", "")],
                                 "doc_key string, title string, category string, status string, recorded_at string, uploaded_at string")
    sums = spark.createDataFrame([("a", "The deal was closed."), ("a", "Met with Acme Corp.")], "doc_key string, summary string")
    none = spark.createDataFrame([], "doc_key string, transcript string")
    names = EN.load_entities(spark.createDataFrame([("Acme Corp", "Companies")], "name string, type string"))
    run = E.enrich_batch(docs, sums, none, names, "2025-01-15", "2025-01-15")
    assert [r["companies"] for r in run.candidates.collect()] == [["Acme Corp"]]


def test_text_tables_of_the_stream_are_packed(spark):
    _root, t, *_ = SP._ingest_env(spark, SF_SMALL)
    assert all(".zstd." in f for f in spark.read.parquet(t.summaries_path).inputFiles())


def test_common_anchors_make_no_rows_for_other_names(spark):
    """Names that share their words: a word of them by itself is no place for a name."""
    names = [(f"{a} {b}", "Projects", 3) for a in ("red", "old", "new") for b in ("ring", "bolt", "gear")] + [("the ring co.", "People", 1)]
    ents = spark.createDataFrame(names, "name string, type string, type_rank int")
    text = "ring and bolt, red or new; gear of old days. " * 20 + "Red Ring, old bolt; the ring co.new-gear"
    docs = spark.createDataFrame([(f"d{k}", text) for k in range(3)], "doc_key string, text string")
    words = EN.name_words(ents)
    assert EN.candidate_places(EN.word_index(docs, words), words).count() <= 3 * 5
    found = {(r["doc_key"], r["name"]) for r in EN.entity_mentions(docs, ents).collect()}
    assert found == {(f"d{k}", n) for k in range(3) for n in ("red ring", "old bolt", "the ring co.")}


def test_an_earlier_run_moves_only_its_own_texts(spark, monkeypatch):
    made, real = [], EP.E.enrich_batch
    monkeypatch.setattr(EP.E, "enrich_batch", lambda *a, **b: made.append(a) or real(*a, **b))
    EP._batch_after_previous(spark, SF_SMALL)
    docs, summaries, transcripts = made[0][:3]
    for side in (docs, summaries, transcripts):
        assert side.count() > 0 and side.where("doc_id % 6 <> 0").count() == 0
    assert made[1][1].where("doc_id % 6 <> 0").count() > 0


def test_scan_lists_and_opens_files_in_tasks(spark, tmp_path):
    from recflow.sources import documents as D
    files = {"Business/a b.md": "x\r\ny\rz", "Business/a b.summary.md": "s", "Business/é%.md": "ü", "Business/n.txt": "t", "Business/empty.md": "",
             "Business/_hidden.md": "h", "Business/.dot.md": "d", "Business/_in/c.md": "c", "Business/new folder%/d.md": "d",
             "_unclassified/k=1.md": "﻿k", "Casual/.keep": ""}
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "Business/bad.md").write_bytes(b"a\xffb")
    root = tmp_path.as_uri()
    got = D.scan_documents(spark, root, ["Business", "_unclassified", "Casual", "Learning"])
    assert got.inputFiles() == []  # the driver lists no file
    raw = (spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true")
           .text([f"{root}/{b}" for b in ("Business", "_unclassified", "Casual")], wholetext=True)
           .selectExpr("regexp_extract(_metadata.file_path, '([^/]+)/[^/]+$', 1) AS bucket", "_metadata.file_name AS name",
                       "hex(regexp_replace(value, '\r\n?', '\n')) AS text").where("name NOT LIKE '%.summary.md'"))
    found = sorted(map(tuple, got.selectExpr("bucket", "file_name", "hex(text)").collect()))
    assert found == sorted(map(tuple, raw.collect())) and len(found) == 5
    assert {r.stem for r in got.collect()} == {"a%20b", "é%25", "d", "k=1", "bad"}
    assert D.scan_documents(spark, root, ["Casual"]).collect() == [] and D.scan_documents(spark, root, ["Learning"]).collect() == []


def test_words_are_cut_without_a_pattern_a_word(spark):
    texts = [(1, "One two,  three"), (2, "--Ünï été: naïve_x 9½"), (3, ""), (4, None), (5, " .,"), (6, "éa\n\nb " + "𝒳 ok" * 3)]
    df = spark.createDataFrame(texts, "id int, text string")
    cut = EN._words_of(df, ["id"], "text")
    want = sorted((i, no, m[1], m[2]) for i, t in texts for no, m in enumerate(re.finditer(r"(\W*)(\w+)", t or "")))
    assert sorted(tuple(r[c] for c in ("id", "_no", "_pre", "_part")) for r in cut.collect()) == want
    names = EN.stored(EN.name_words(spark.createDataFrame([("Two Three.",)], "name string")), "t")
    p = EN.word_index(df, names, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(" not in p and p.count("regexp_extract_all(") == 2  # the text is cut once, by two patterns
