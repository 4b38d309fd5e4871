"""N-gram Jaccard join by MinHash banding.

Documents become sets of five-word shingles.  Documents of one set are a class and only the
smallest id stands for it, so exact copies meet once.  Each class gets bands x rows MinHash
values; the two counts follow from the similarity and the recall asked for.  Classes that
share a band's hash are verified on their full sets:

* in a bucket of at most SMALL classes, as distinct pairs;
* in a larger bucket, in pairs of bounded blocks: a task counts the common shingles of its
  two blocks in one matrix and returns one row per class (links, local component), never
  the pairs.  A pair that meets in several large buckets counts in the least of them.

Links are then united to groups by alternating large and small stars.

Defined results: words are runs of non-white-space; a text of one to four words is one
shingle; null, empty and blank texts have no shingles and link with nothing; a null id links
with nothing and has a null class; rows that repeat id and text are copies; an id that
repeats with other texts is several documents, each linked by its own text, and of the least
id's texts in a group the one of least hash stands for it; extra columns are ignored.  Shingles are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import packed, ship, stored, text_of, unpacked

ship(__name__)

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 128
#: Classes of a bucket that are paired directly; larger buckets go by blocks.
SMALL = 24
#: A block's classes and shingles.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 2_000_000

_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows (fewest chance candidates) whose bands find a pair of
    just this similarity with this probability within so many hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, hashes: _WordHashes, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the text's word n-grams."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    total = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        total += h[k:k + n] * _PLACE[k % 5] + np.uint64(k // 5)
    return np.unique(_mix(total))


def _minhashes(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 8192):
        part = grams[start:start + 8192, None] * a + b
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _class(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def signer(bands: int, rows: int, size: int = WORDS):
    rng = np.random.default_rng(20_240_601)
    a = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    place = rng.integers(1, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for texts in batches:
            classes, sizes, keys = [], [], []
            for text in texts:
                grams = shingles(text.as_py(), hashes, size)
                sizes.append(len(grams))
                if not len(grams):
                    classes.append(None)
                    keys.append(None)
                    continue
                m = _minhashes(grams, a, b).reshape(bands, rows)
                hashed = _mix((m * place).sum(axis=1, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64))
                classes.append(_class(grams))
                keys.append(hashed.view(np.int64))
            yield pa.StructArray.from_arrays([pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["cls", "size", "keys"])

    return F.arrow_udf(sign, "cls binary, size long, keys array<long>")


def grammer(size: int = WORDS):
    def gram(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for texts in batches:
            sets = [shingles(t.as_py(), hashes, size) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([_class(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "grams"])

    # else a null check on its result would be pushed below the semi join, to all documents
    return F.arrow_udf(gram, "cls binary, grams binary").asNondeterministic()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _similar(a_grams: pd.Series, b_grams: pd.Series) -> pd.Series:
    return pd.Series([similarity(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
                      for a, b in zip(a_grams, b_grams, strict=True)], dtype="float64")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of how many shingles each two sets share."""
    n = len(sets)
    out = np.zeros((n, n), np.int32)
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    ends = np.append(starts[1:], len(grams))
    for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
        who = owner[s:e]
        out[np.ix_(who, who)] += 1
    return out


def _components(linked: np.ndarray) -> np.ndarray:
    """The least index that each row reaches."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def block_verifier(threshold: float):
    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        """One bucket's block pair: a row per class with its links here and its local component."""
        rows = rows.sort_values("node", ignore_index=True)
        key, low, high = int(rows["key"].iloc[0]), int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        sets = [np.frombuffer(g, np.uint64) for g in rows["grams"]]
        size = np.array([len(s) for s in sets])
        common = _common(sets)
        linked = common / (size[:, None] + size[None, :] - common) >= threshold
        block = rows["block"].to_numpy()
        linked &= (block[:, None] != block[None, :]) if low != high else True
        np.fill_diagonal(linked, False)
        owned = np.ones_like(linked)
        holders: dict[int, list[int]] = {}
        for i, keys in enumerate(rows["crowds"]):
            for k in keys:
                if k < key:
                    holders.setdefault(int(k), []).append(i)
        for who in holders.values():
            owned[np.ix_(who, who)] = False
        links = (linked & owned) @ rows["copies"].to_numpy(np.int64)
        node = rows["node"].to_numpy()
        out = pd.DataFrame({"node": node, "label": node[_components(linked)], "links": links})
        return out[linked.any(axis=1)]

    return verify


def connected(edges: DataFrame) -> DataFrame:
    """node, root for each node of ``edges`` (u > v): root is the least of its component.

    Alternating large and small stars; only grouped minima and equi-joins, no node's
    neighbours are gathered.  Each round is written to the shared folder."""
    def fingerprint(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = stored(edges.select("u", "v").distinct(), "edges")
    before = fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = (hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "small-star")
        after = fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             size: int = WORDS, recall: float = RECALL) -> DataFrame:
    """A row per document: id, tie (hash of its text), rep, class_id, n_links, stands (for its group)."""
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    signed = stored(texts.select("id", "tie", signer(bands, rows, size)(F.col("text")).alias("s")).select("id", "tie", "s.*"), "signed")
    known = signed.where("cls IS NOT NULL AND id IS NOT NULL")
    # the least id of a class stands for it, with its signature; an id may stand for several, so the
    # graph's nodes are numbers of classes, fixed by being written
    reps = stored(known.groupBy("cls").agg(F.min(F.struct("id", "tie", "size", "keys")).alias("r"), F.count("*").alias("copies"))
                  .select(F.monotonically_increasing_id().alias("node"), "cls", "copies", F.col("r.id").alias("rep"),
                          F.col("r.tie").alias("tie"), "r.size", "r.keys"), "reps")
    keyed = reps.select("node", "size", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("grams")).where("n > 1")
    members = stored(keyed.select("node", "key").join(shared, "key"), "members")

    few = members.where(F.col("n") <= SMALL).select("key", "node")
    pairs = stored(few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key")
                   .where("a < b").select("a", "b").distinct(), "pairs")
    crowded = members.where(F.col("n") > SMALL)
    crowds = crowded.groupBy("node").agg(F.collect_set("key").alias("crowds"))  # at most one key a band
    wanted = (pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
              .unionByName(crowded.select("node")).distinct())
    wanted = wanted.join(reps.select("node", "rep", "tie", "cls", "copies"), "node")
    grams = (texts.join(wanted.select(F.col("rep").alias("id"), "tie"), ["id", "tie"], "left_semi")
             .select(F.col("id").alias("rep"), "tie", grammer(size)(F.col("text")).alias("g")).select("rep", "tie", "g.*"))
    sets = stored(grams.dropDuplicates(["rep", "tie", "cls"]).join(wanted, ["rep", "tie", "cls"]).join(crowds, "node", "left")
                  .select("node", "copies", "grams", F.coalesce("crowds", F.array().cast("array<long>")).alias("crowds")), "sets")

    side = lambda x: sets.select(*(F.col(c).alias(f"{x}{'' if c == 'node' else '_' + c}") for c in sets.columns))
    verified = (pairs.join(side("a"), "a").join(side("b"), "b").where(~F.arrays_overlap("a_crowds", "b_crowds"))
                .withColumn("s", F.pandas_udf(_similar, "double")("a_grams", "b_grams")).where(F.col("s") >= threshold)
                .select("a", "b", "a_copies", "b_copies"))
    verified = stored(verified, "verified")

    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_SHINGLES)).cast("long")
    placed = (crowded.select("key", "node", blocks.alias("blocks")).join(sets, "node")
              .withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                      "block", "node", "copies", "grams", "crowds"))
    crowd_links = stored(placed.groupBy("key", "low", "high").applyInPandas(
        block_verifier(threshold), "node long, label long, links long"), "crowd-links")

    edges = (verified.select(F.col("b").alias("u"), F.col("a").alias("v"))
             .unionByName(crowd_links.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v"))))
    roots = connected(edges)
    links = (verified.select(F.col("a").alias("node"), F.col("b_copies").alias("links"))
             .unionByName(verified.select(F.col("b").alias("node"), F.col("a_copies").alias("links")))
             .unionByName(crowd_links.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links")))
    groups = (reps.select("cls", "node", "rep", "tie", "copies").join(links, "node", "left").join(roots, "node", "left")
              .where("copies > 1 OR links IS NOT NULL OR root IS NOT NULL")
              .select("cls", "rep", "tie", F.coalesce("root", "node").alias("root"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    groups = stored(groups, "groups")
    least = groups.groupBy("root").agg(F.min(F.struct("rep", "tie")).alias("least"))
    groups = groups.join(least, "root").select("cls", "rep", F.col("least.rep").alias("class_id"), F.col("least.tie").alias("least_tie"), "n_links")
    stands = F.col("class_id").isNull() | (F.col("class_id") == F.col("id")) & (F.col("least_tie") == F.col("tie"))
    return (signed.select("id", "tie", "cls").join(groups, "cls", "left")
            .select("id", "tie", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep"),
                    F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"),
                    F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                    (F.col("id").isNull() | stands).alias("stands")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per document: id, rep (of its class), class_id (of its group of linked
    documents: the least id), n_links (other documents at this similarity or more)."""
    return _grouped(docs, id_col, text_col, **options).select("id", "rep", "class_id", "n_links")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stand for their groups, with all their columns; null ids stay."""
    gone = stored(_grouped(docs, id_col, text_col, **options).where("NOT stands")
                  .select(F.col("id").alias("gone"), F.col("tie").alias("gone_tie")).distinct(), "gone")
    return unpacked(packed(docs, id=F.col(id_col), tie=F.xxhash64(text_of(text_col)))
                    .join(gone, (F.col("id") == F.col("gone")) & (F.col("tie") == F.col("gone_tie")), "left_anti"))
