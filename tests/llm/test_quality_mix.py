"""Quality rules and the source mix."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recflow.llm import mixing as M
from recflow.llm import quality as Q

from .conftest import SCHEMA, SF, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(t):
    t = t or ""
    w = WORD.findall(t)
    wins = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    n = Counter(wins)
    rep = {i for k, x in enumerate(wins) if n[x] > 1 for i in range(k, k + 3)}
    dup, seen = 0, set()
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep)


def test_stats_equal_brute_force(odd_rows):
    rng = random.Random(4)
    texts = [r[1] or "" for r in odd_rows] + ["a a a a", "a b c a b c a b", "x\nx\n\n \nx", "\x1c\x1d a\xa0b #|<é>"]
    texts += [" ".join(rng.choice("ab") for _ in range(30)) for _ in range(50)]
    for t in texts:
        assert Q.text_stats(t)[:5] == brute_stats(t), t[:50]


def test_rule_list_is_learned_and_emitted_as_case_when(spark):
    rng = np.random.default_rng(3)
    n = 3000
    stats = pd.DataFrame({s: rng.integers(60, 400, n) for s in Q.STATS})
    stats["n_symbols"] = rng.integers(0, 20, n)
    bad = (stats["n_symbols"] / stats["n_words"] >= 0.08).to_numpy() | (stats["n_digits"] / stats["word_chars"] > 4).to_numpy()
    rules = Q.learn(stats, bad)
    x = Q.feature_arrays(stats)
    hit = np.zeros(n, bool)
    for r in rules:
        hit |= Q._covered(r, x, n)
    assert rules and (hit == bad).mean() > 0.95
    df = spark.createDataFrame(stats).select(F.struct("*").alias("_stats"))
    assert [r[0] > 0 for r in df.select(Q.rule_column(rules)).collect()] == hit.tolist()


def test_quality_odd_rows_and_held_out_accuracy(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(12, 1, 0), (13, None, None), (None, 0, 0), (12, 0, 1)], "doc_id long, quality int, toxic int")
    got = Q.judge(odd, Q.fit(odd, labels)).select("doc_id", "text", "_quality.*").collect()
    assert len(got) == len(odd_rows)
    for r in got:
        n = brute_stats(r.text)
        assert (r.n_words, r.n_repeat_words) == (n[0], n[4])
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and (not r.base_failed or not r.kept)
    kept = Q.filter_quality(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)
    assert Q.filter_quality(none, labels.limit(0)).collect() == []
    docs, marks = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = Q.fit(docs, marks.where("doc_id % 2 = 0"))
    test = Q.judge(docs, train).join(marks.where("doc_id % 2 = 1"), "doc_id").where("NOT _quality.base_failed")
    right = test.select(F.avg((F.col("_quality.kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.95


def level(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing what is above the cap, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full, target = share * sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        target = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if target[s] > most * sizes[s]]
        if not over:
            return {**full, **target}
        full.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1000, "c": 5, None: 50}, {"a": 10, "b": 10}, {"z": 7}, {"a": 0, "b": 9, "é": 3, "Z": 900}])
def test_targets_equal_repeated_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    assert got == pytest.approx(level(sizes))


def test_permutation_is_a_bijection_and_inverts(spark):
    for n in (1, 2, 7, 64, 1000):
        x = M.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("s:0"))
        rows = spark.range(n).select("id", x.alias("p")).select("id", "p", M.permuted(F.col("p"), F.lit(n).cast("long"), F.lit("s:0"), back=True).alias("b")).collect()
        assert sorted(r.p for r in rows) == list(range(n)) and all(r.b == r.id for r in rows)


def test_mix_reaches_targets_and_reruns_agree(spark, odd, odd_rows, none):
    rng = random.Random(8)
    rows = [(k, words(rng, rng.randrange(0, 400)), None, rng.choice(["a", "a", "a", "a", "b", "c", None]), None) for k in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.mix(docs, block=32).collect()
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    by = defaultdict(list)
    source = {r[0]: r[3] for r in rows}
    for r in got:
        assert r.size == size[r.id] and 0 <= r.taken <= 2 * r.size
        by[source[r.id]].append(r)
    want = level({s: sum(x.size for x in v) for s, v in by.items()})
    for s, v in by.items():
        assert v[0].target == pytest.approx(want[s]) and abs(sum(x.taken for x in v) - v[0].target) <= 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, M.mix(docs.repartition(7), block=32).collect()))
    assert len(M.mix(odd).collect()) == len(odd_rows) and M.mix(none).collect() == []
    kept = M.resample(odd)
    assert kept.columns == odd.columns
    assert M.resample(none).collect() == []


def test_resampled_words_reach_each_sources_target_at_any_length(spark):
    """Documents much longer than a block are no more and no less likely than short ones."""
    rng = random.Random(10)
    rows = [(k, "w " * (rng.randrange(2500, 3500) if rng.random() < 0.1 else rng.randrange(50, 150)), None, "abcdef"[k % 6], None)
            for k in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    size, source = {r[0]: len(r[1].split()) for r in rows}, {r[0]: r[3] for r in rows}
    target = {source[r.id]: r.target for r in M.mix(docs).collect()}
    words, long, all_words, all_long = Counter(), Counter(), Counter(), Counter()
    for r in M.resample(docs).collect():
        words[r.source] += size[r.doc_id]
        long[r.source] += size[r.doc_id] * (size[r.doc_id] > 2000)
    for k, s in source.items():
        all_words[s] += size[k]
        all_long[s] += size[k] * (size[k] > 2000)
    assert min(target[s] / all_words[s] for s in all_words) < 0.95
    for s in all_words:
        assert words[s] == pytest.approx(target[s], rel=0.08), s
        assert long[s] / all_long[s] == pytest.approx(target[s] / all_words[s], rel=0.15), s


@pytest.mark.parametrize("ratio", [0.2, 0.4, 0.805, 1.5])
def test_copies_of_long_documents_keep_the_ratio(spark, ratio):
    rng = random.Random(12)
    sizes = [rng.randrange(1280, 20000) for _ in range(600)] + [0]
    rows = [(k, k, k * 31, 1 + k % 2, n, round(ratio * n)) for k, n in enumerate(sizes)]
    got = M.copies(spark.createDataFrame(rows, "row long, id long, tie long, source_no long, size long, taken long")).collect()
    assert len(got) == len(rows) and all(r.times in (int(ratio), int(ratio) + 1) or r.size == 0 == r.times for r in got)
    for s in (1, 2):
        assert sum(r.times * r.size for r in got if r.source_no == s) == pytest.approx(
            sum(r.taken for r in got if r.source_no == s), rel=0.06)


def test_ids_with_several_texts_are_mixed_by_row(spark):
    """One id on all rows: its long texts are drawn as often as their words are, blocks hold each row's own words."""
    rng = random.Random(11)
    rows = [(1 if k % 2 else None, f"r{k} " * rng.choice([40, 900]), None, "abcdef"[k % 6], None) for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    own = lambda t: t.split()[0]
    target = {r.source_no: r.target for r in M.mix(docs).collect()}
    words, times = Counter(), Counter()
    for r in M.resample(docs).collect():
        words["abcdef".index(r.source) + 1] += len(r.text.split())
        times[own(r.text)] += 1
    assert max(times.values()) <= 2 and len(set(times.values())) > 1
    assert words == {s: pytest.approx(t, rel=0.08) for s, t in target.items()}
    place = {own(r[1]): "abcdef".index(r[3]) + 1 for r in rows}
    got = Counter()
    for r in M.mixed_blocks(docs).collect():
        got[r.source_no] += len(r.text.split())
        assert {place[w] for w in r.text.split()} == {r.source_no}
    assert got == {s: pytest.approx(t, abs=1) for s, t in target.items()}


def test_blocks_hold_the_words_taken(spark):
    rng = random.Random(9)
    rows = [(k, words(rng, rng.randrange(1, 90)), None, "ab"[k % 2], None) for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    blocks = M.mixed_blocks(docs, block=32).collect()
    taken = {r.source_no: 0 for r in blocks}
    for r in blocks:
        taken[r.source_no] += len(r.text.split())
    want = defaultdict(int)
    for r in M.mix(docs, block=32).collect():
        want[r.source_no] += r.taken
    assert taken == want
    assert set(" ".join(r.text for r in blocks).split()) <= set(" ".join(r[1] for r in rows).split())


def test_taken_comes_from_the_slots_that_shards_draw(spark):
    """Each document's words, by brute force from the drawn blocks; counts by shard are multinomial."""
    docs = spark.read.parquet(f"{SF.replace('0.01', '0.001')}/documents.parquet")
    placed, sources = M.place_documents(docs, "doc_id", "text", "source")
    plan = M._plan(sources, 16)
    counts = M.shard_counts(plan, 64).collect()
    slots = {r.source_no: r.slots for r in plan.collect()}
    shards = 1 + max(r.shard for r in counts)
    spread = 0.0
    for no, total in slots.items():
        mine = sorted((r.shard, r["first"], r["count"]) for r in counts if r.source_no == no)
        at = 0
        for _, first, count in mine:  # consecutive ranges
            assert first == at
            at += count
        assert at == total
        by = [c for _, _, c in mine] + [0] * (shards - len(mine))
        spread += sum((c - total / shards) ** 2 / max(total / shards, 1e-9) for c in by) / (shards - 1) / len(slots)
    assert 0.7 < spread < 1.4  # chi-square over its degrees of freedom
    blocks = {}
    for r in M.draw(plan, 64).collect():
        blocks.setdefault((r.source_no, r.block), []).append(r.cut)
    want = {}
    for d in placed.collect():
        words = 0
        for w in range(d.start, d.start + d.size):
            words += sum(cut is None or w % 16 < cut for cut in blocks.get((d.source_no, w // 16), []))
        want[d.id] = words
    out = M.mix(docs, block=16)
    assert {r.id: r.taken for r in out.collect()} == want
    assert str(M.SEED + 2) in M.shard_counts(plan)._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_one_id_are_spread_over_chunks(spark):
    from pyspark.sql import functions as F
    docs = spark.range(60_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word w"), "id").alias("text"),
                                      F.lit("hot").alias("source"))
    out = M.mix(docs)
    assert out.count() == 60_000 and out.agg(F.sum("taken")).first()[0] == 180_000


def test_the_mix_does_not_depend_on_where_rows_stand(spark, tmp_path):
    docs = spark.read.parquet(f"{SF.replace('0.01', '0.001')}/documents.parquet")
    docs.repartition(5, "source").write.parquet(f"{tmp_path}/a")
    docs.repartition(3, "doc_id").write.parquet(f"{tmp_path}/b")
    a, b = (sorted(r.doc_id for r in M.resample(spark.read.parquet(f"{tmp_path}/{x}"), in_files=True).collect()) for x in "ab")
    assert a == b and len(a) > 200
