"""Exact dedup and the n-gram join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from recflow.llm import exact_dedup as E
from recflow.llm import ngram_join as N

from .conftest import SCHEMA, words


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_groups_equal_brute_force(odd, odd_rows):
    got = E.exact_groups(odd).collect()
    keep, size = {}, Counter(norm(r[1]) for r in odd_rows)
    for r in odd_rows:
        if r[0] is not None:
            keep[norm(r[1])] = min(keep.get(norm(r[1]), r[0]), r[0])
    want = Counter((r[0], keep[norm(r[1])], size[norm(r[1])], r[0] == keep[norm(r[1])],
                    hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in odd_rows)
    assert Counter(tuple(r) for r in got) == want


def test_exact_keeps_one_row_of_each_text(odd, odd_rows, none):
    got = E.drop_copies(odd)
    assert got.columns == odd.columns
    assert Counter(norm(r.text) for r in got.collect()) == Counter({norm(r[1]) for r in odd_rows})
    assert E.drop_copies(none).collect() == [] and E.exact_groups(none).collect() == []


def test_exact_keeps_texts_found_nowhere_else_of_repeated_ids(spark):
    rows = [(1, "copied"), (None, "copied"), (None, "alone"), (7, "copied"), (7, "mine"), (8, "other"), (None, "alone")]
    got = E.drop_copies(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, "copied"), (None, "alone"), (7, "mine"), (8, "other")])


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key")
    depth, slots = E.directory(keys, capacity=100)
    rows = slots.collect()
    counts = Counter()
    bucket = {r.slot: r.bucket for r in rows}
    for (k,) in keys.collect():
        counts[bucket[(k & (2**64 - 1)) >> (64 - depth)]] += 1
    assert depth >= 5 and max(counts.values()) <= 100 and sum(counts.values()) == 3000
    assert any(r.local_depth < depth for r in rows)  # sibling slots that fit share a bucket


def test_results_come_through_the_directory(spark):
    """Any right directory gives the groups; one that lacks slots, or holds one twice, does not."""
    docs = spark.createDataFrame([(k, f"t{k % 40}", None, None, None) for k in range(200)], SCHEMA)

    def groups(using, capacity=4):
        return Counter(tuple(r) for r in E.exact_groups(docs, capacity=capacity, using=using).collect())

    def lacking(keys, capacity):
        depth, slots = E.directory(keys, capacity)
        return depth, slots.where("slot % 2 = 0")

    def doubled(keys, capacity):
        depth, slots = E.directory(keys, capacity)
        return depth, slots.unionByName(slots.selectExpr("slot", "local_depth", "bucket + 1000 AS bucket"))

    right = groups(E.directory)
    assert right == groups(E.directory, capacity=65_536) and {r[2] for r in right} == {5} and right.total() == 200
    assert groups(lacking) != right and groups(doubled) != right
    _, index = E.build_index(docs, capacity=4)
    sizes = Counter(r.bucket for r in index.collect())
    assert len(sizes) > 5 and max(sizes.values()) <= 4  # buckets have split


def test_collision_chain_tells_texts_apart(spark):
    """Entries of one key are told apart by their digest, grouped by their bytes."""
    docs = spark.createDataFrame([(k, f"t{k % 3}", None, None, None) for k in range(30)], SCHEMA)
    _, index = E.build_index(docs, capacity=1)
    assert sorted((r.keep_id, r.group_size) for r in index.collect()) == [(0, 10), (1, 10), (2, 10)]


def brute(rows, threshold=0.8):
    """(links of a row, class) by id, over shingle sets; null ids and blank texts link with nothing."""
    sets = [(r[0], shingle_set(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = defaultdict(int)
    posting = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        common = Counter(j for g in s for j in posting[g])
        for g in s:
            posting[g].append(k)
        for j, n in common.items():
            o = sets[j][0]
            if n / (len(s) + len(sets[j][1]) - n) >= threshold:
                links[k] += 1
                links[j] += 1
                a, b = find(i), find(o)
                parent[max(a, b)] = min(a, b)
    return {i: links[k] for k, (i, _) in enumerate(sets)}, {i: find(i) for i, _ in sets}


def shingle_set(t):
    w = (t or "").encode().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_near_groups_equal_brute_force(odd, odd_rows, none):
    links, group = brute(odd_rows)
    for r in N.near_groups(odd).collect():
        if r.id is None:
            assert r.class_id is None and r.n_links == 0
        else:
            assert (r.class_id, r.n_links) == (group[r.id], links[r.id]), r
    assert N.near_groups(none).collect() == []
    kept = N.one_of_each(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, *(i for i in group if group[i] == i)}


@pytest.mark.parametrize("small", [24, 0])
def test_an_id_with_several_texts_is_several_documents(spark, monkeypatch, small):
    rng = random.Random(3)
    a, b, c, d = (words(rng, 120) for _ in range(4))
    rows = [(5, a), (6, a + " x"), (5, b), (7, b + " y"), (7, c), (9, c + " z"), (9, d), (5, d + " w"), (5, d + " v")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    monkeypatch.setattr(N, "SMALL", small)
    got = Counter(tuple(r) for r in N.near_groups(docs).select("id", "class_id", "n_links").collect())
    assert got == Counter([(5, 5, 1), (6, 5, 1), (5, 5, 1), (7, 5, 1), (7, 7, 1), (9, 7, 1), (9, 5, 2), (5, 5, 2), (5, 5, 2)])
    kept = Counter((r.doc_id, r.text) for r in N.one_of_each(docs).collect())
    (last,) = [t for i, t in kept if i == 5 and t.startswith(d)]
    assert kept == Counter([(5, a), (5, b), (7, c), (5, last)])


@pytest.mark.parametrize("small", [24, 3])
def test_crowded_buckets_by_blocks_lose_no_link(spark, monkeypatch, small):
    """A large group of near copies: block pairs give the links and groups of all pairs."""
    rng = random.Random(2)
    base = words(rng, 150).split()
    rows = []
    for k in range(90):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((k * 3 + 1, " ".join(w), None, None, None))
    rows += [(1000 + k, rows[k][1], None, None, None) for k in range(5)]
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "BLOCK_ROWS", 20)
    links, group = brute(rows)
    got = N.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.id: r.class_id for r in got} == group
    assert {r.id: r.n_links for r in got} == {i: links[i] for i in group}
    assert sum(links.values()) > 1000


def test_bands_reach_the_recall():
    bands, rows = N.choose_bands(0.8, 0.9995)
    assert bands * rows <= N.MAX_HASHES and 1 - (1 - 0.8**rows) ** bands >= 0.9995


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(101, 100)], "u long, v long")
    assert {r.node: r.root for r in N.connected(edges).collect()} == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_common_counts_and_local_components():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, 30).astype(np.uint64)) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = N._common(sets)
    assert (got == np.array(want)).all()
