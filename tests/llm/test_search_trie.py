"""Conversation trie, nearest vectors and lexical search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.llm import lexical as L
from recflow.llm import prefix_trie as T
from recflow.llm import vector_search as V

from .conftest import SF


# --- the trie ---------------------------------------------------------------------------------

def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        leaves = sum(not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(x) == len(node) + 1 for x in below), leaves, saved, digest))
    return sorted(out, key=str)


def conversations(rng, n=260):
    rows = []
    for c in range(n):
        length = rng.choice([1, 1, 2, 3, 4, 7, 12])
        for t in range(length):
            # a third of all conversations are one and the same, another third begin alike
            text = f"same {t}" if c % 3 == 0 else "same 0" if c % 3 == 1 and t == 0 else "x" * rng.randrange(4)
            rows.append((c, t, rng.choice(["user", "user", None, ""]) if c % 3 == 2 else "user", text))
    rows += [(300, None, "user", "null turn"), (300, 0, None, None), (400, 5, "a:b", ""), (401, 5, "a", ":b"), (None, 1, "user", "nobody")]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("sizes", [{}, {"shard": 6, "held": 3, "chunk": 2, "piece": 4}])
def test_trie_equals_brute_force(spark, sizes):
    rows = conversations(random.Random(4))
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(c) for c in ("conv", "name", "d", "label")))
    got = sorted((tuple(r) for r in T.build(df, **sizes).collect()), key=str)
    assert got == brute_trie(rows)


def test_trie_of_a_long_conversation_and_of_none(spark):
    rows = [(c, t, "user", "a") for c in (1, 2) for t in range(60 + c)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in T.build(df, shard=5, held=2, chunk=7).collect()), key=str)
    assert got == brute_trie(rows)
    assert T.build(df.limit(0)).collect() == []


def test_repeated_turn_numbers_have_one_order(spark):
    rows = [(7, 1, "user", t) for t in "abcabc"]
    a, b = (sorted(map(tuple, T.build(spark.createDataFrame(x, SCHEMA)).collect()), key=str) for x in (rows, rows[::-1]))
    assert a == b and len(a) > 1


def test_queue_spills_and_gives_back_in_order():
    rng, queue, sent = random.Random(1), T.SpillingQueue(held=10, runs=7), defaultdict(list)
    for _ in range(500):
        key = (rng.randrange(5), bytes([rng.randrange(8)]) * len(T.ROOT))
        counts = tuple(rng.randrange(9) for _ in range(3))
        sent[key].append(counts)
        queue.push(*key, *counts)
    assert queue.written > 40 and len(queue.runs) <= 7 and len(queue.heap) <= 10
    for key in sorted(sent, key=lambda k: (-k[0], k[1])):
        assert sorted(queue.take(*key)) == sorted(sent[key])
    assert not queue.heap and not queue.runs


# --- nearest vectors ----------------------------------------------------------------------------

def brute_nearest(rows, k):
    """``rows`` (id, vector) that take part, each pair once; {query: [(id, distance)]}."""
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((points - points[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query, r["rank"])):
        assert r["rank"] == len(out[r.query]) + 1
        out[r.query].append((r.id, r.distance))
    return out


def test_recall_on_the_table_and_exact_scores(spark):
    df = spark.read.parquet(f"{SF.replace('0.01', '0.1')}/embeddings.parquet")
    want = brute_nearest([(r.vec_id, r.embedding) for r in df.collect()], 10)
    got = found(V.search(df, F.col("id") % 100 == 0, "vec_id", "embedding", block=300, group=7))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({x for x, _ in got[q]} & {x for x, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, pairs in got.items():
        for x, d in pairs:
            assert all(d == e for y, e in want[q] if y == x)


def test_copies_odd_vectors_and_few_candidates(spark):
    rng = np.random.default_rng(2)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 400, 3)] + [(i, rng.normal(size=3).tolist()) for i in range(1, 400, 3)]
    odd = [(500, None), (600, [0.0, 0.0, 0.0]), (700, [1.0, None, 2.0]), (800, [1.0, float("nan"), 2.0]), (801, [1.0, float("inf"), 2.0]),
           (900, [1.0, 2.0]), (None, [1.0, 2.0, 4.0]), (901, [])]
    df = spark.createDataFrame(rows + rows[:50] + odd, "id int, vector array<double>").withColumn("rep", F.lit("clash"))
    want = brute_nearest(rows, 10)
    got = found(V.search(df, F.col("id") % 100 == 0, k=10, lists=4, list_size=20))
    assert sorted(got) == [0, 100, 300]
    for q in (0, 300):  # all of a vector's copies but its own are nearest, the smaller ids first
        assert got[q] == want[q]
    assert len({x for x, _ in got[100]} & {x for x, _ in want[100]}) >= 8
    twice = [(100, [0.0, 1.0]), (100, [5.0, 1.0]), (101, [0.0, 1.0]), (102, [4.0, 1.0])]  # an id with two vectors: both are asked for
    got = V.search(spark.createDataFrame(twice, "id int, vector array<float>"), F.col("id") % 100 == 0).collect()
    assert Counter((r.query, r["rank"], r.id, r.distance) for r in got) == Counter(
        [(100, 1, 101, 0.0), (100, 2, 102, 4.0), (100, 3, 100, 5.0), (100, 1, 102, 1.0), (100, 2, 100, 5.0), (100, 3, 101, 5.0)])
    few = found(V.search(spark.createDataFrame(rows[:3], df.drop("rep").schema), F.col("id") % 100 == 0))
    assert few == {0: [(3, 0.0), (6, 0.0)]}
    assert V.search(df.limit(0), F.col("id") % 100 == 0).collect() == []
    assert V.search(df.where("id = 0"), F.col("id") % 100 == 0).collect() == []


def test_parts_are_balanced_and_boundary_vectors_are_copied():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6)) * 3
    points = centres[rng.integers(4, size=2000)] + rng.normal(size=(2000, 6))
    parts = V.halved(points, 64, rng)
    assert sorted(np.concatenate(parts).tolist()) == list(range(2000))
    assert max(map(len, parts)) <= 64 and max(map(len, parts)) - min(map(len, parts)) <= 1
    index = V.fit(points, 32)
    lists = index.lists_of(points)
    assert all(1 <= len(x) <= V.REPLICAS for x in lists) and any(len(x) > 1 for x in lists)
    nearest = V.squares(points, index.centroids).argmin(1)
    assert all(x[0] == n for x, n in zip(lists, nearest, strict=True))


def test_graph_search_finds_all_centroids_within_the_ratio():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3000, 16))
    index = V.fit(points, 100)
    missed = total = 0
    for q in rng.normal(size=(50, 16)):
        d = np.sqrt(((index.centroids - q) ** 2).sum(1))
        want = set(np.flatnonzero(d <= index.reach(d.min())).tolist())
        got = set(index.search(q))
        assert got <= want
        missed, total = missed + len(want - got), total + len(want)
    assert missed <= 0.02 * total


# --- lexical search -----------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_search(docs, items, k=10):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked = sorted(set(TERM.findall((text or "").translate(LOWER))))
        scored = []
        for i, c in counts:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank + 1, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def lexical_docs(rng):
    words = [f"w{i}" for i in range(60)] + ["Été", "straße", "a1"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randrange(1, 90)))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(300)]  # a large group of copies
    docs += [(2000, None), (2001, ""), (2002, " ,;\t"), (None, docs[5][1]), (5, docs[6][1]), (5, docs[5][1]), (2003, "W1-w2_w3 " * 5000)]
    return docs


@pytest.mark.parametrize("sizes", [{}, {"chunk": 90, "bucket": 3, "block_terms": 40}])
def test_search_equals_brute_force(spark, sizes):
    rng = random.Random(7)
    docs = lexical_docs(rng)
    items = [(i, " ".join(rng.choices([f"W{k}" for k in range(70)] + ["ÉTÉ", "Été", "straße"], k=rng.randrange(1, 20)))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "nowhere"), (3, "w1"), (None, "w2 a1")]
    df = spark.createDataFrame(docs, "doc_id int, text string").select("*", *(F.lit("x").alias(c) for c in ("id", "terms", "n", "no")))
    asked = spark.createDataFrame(items, "item_id int, text string").withColumn("terms", F.lit(1))
    got = Counter((r["item"], r["rank"], r["id"], r["score"]) for r in L.search(df, asked, **sizes).collect())
    assert got == brute_search(docs, items)
    assert L.search(df.limit(0), asked).collect() == [] and L.search(df, asked.limit(0)).collect() == []


def test_bounds_hold_and_leave_out_subtrees():
    rng = np.random.default_rng(1)
    rows = [(np.flatnonzero(rng.random(50) < 1 / (1 + np.arange(50) / 5)),) for _ in range(3000)]
    rows = [(r, rng.integers(1, 9, len(r))) for (r,) in rows]
    m = rng.integers(10, 400, len(rows)).tolist()
    tree = L.Tree(rows, m, list(range(len(rows))), 50, bucket=8)
    own = np.zeros((len(tree.m), 50), np.int64)
    own[np.repeat(np.arange(len(tree.m)), np.diff(tree.ptr)), tree.rank] = tree.gain
    for node in range(len(tree.low)):
        assert (tree.bound[node] >= own[tree.low[node]:tree.high[node]].max(axis=0)).all()
    looked, gain_of = [0], np.add.reduceat

    class Counted:
        @staticmethod
        def reduceat(a, b):
            looked[0] += len(b)
            return gain_of(a, b)

    ranks, weights = np.array([3, 20, 44]), np.array([100, 3000, 6000])
    try:
        np_add, L.np.add = np.add, Counted
        got = tree.search(ranks, weights, [])
    finally:
        L.np.add = np_add
    scores = own[:, ranks] @ weights
    assert [s for s, _ in got] == sorted(scores.tolist(), reverse=True)[:10]
    assert looked[0] < len(tree.m) / 2
