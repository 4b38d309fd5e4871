"""Nearest vectors by balanced posting lists.

A bounded sample is halved again and again at the median along its main direction until the
parts are small: as many vectors in each, their means are the centroids.  Every vector of
the table goes into the list of its nearest centroid, and near a boundary into further ones:
those not much farther whose centroid stands apart from the centroids chosen before.  A query searches the centroids in a graph kept in memory (neighbours of centroids,
best first) and takes the lists whose distance is within a ratio of its nearest centroid's.
The ratio is measured on the sample: that which finds ``RECALL`` of the true neighbours of
sampled queries.  The vectors of the lists taken are compared in double precision.

Neighbouring lists stand on a shelf.  A shelf's vectors are cut into blocks and its queries
into groups, so that a task holds one block and one group whatever the size of a list, and a
query gets one answer from a block, the best of those lists of it that the query takes.  Rows of one vector are kept once in the
lists, with the smallest ids that a result can need (one more than asked for); so are
queries of one vector.

Parameters that bound the driver's work: ``SAMPLE`` vectors fit the index, ``LISTS`` centroids
at most are broadcast.  All rows are indexed.

Defined results: a vector that is null, zero or has null or non-finite components takes no
part, nor one whose length isn't the commonest (the shorter of equally common ones), nor a
row without id; rows that repeat an id with another vector are rows of their own, equal rows
count once; a query's own row is no candidate; equal distances go by id; an empty table
gives no rows; other columns don't matter.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import ship, stored

NEAREST = 10
SAMPLE, LISTS, LIST_SIZE = 32_768, 2_048, 128
#: Lists that hold a vector at most, how much farther than the nearest a further one may be, and
#: how near to a centroid chosen before, as a share of its distance to the vector.
REPLICAS, REPLICA_RATIO, APART = 4, 1.06, 0.5
#: Neighbours of a centroid in the graph, centroids that a search visits at least.
DEGREE, VISITS = 24, 48
#: Share of true neighbours that the ratio must find for queries of the sample, their number.
RECALL, TRIALS = 0.97, 512
#: Lists on a shelf (bits of a mask); vectors in a block of a shelf, queries in a group.
SHELF = 32
BLOCK, GROUP = 4_096, 512
#: Vectors compared with all centroids at once.
ROWS = 2_048
SEED = 20_240_611


def clean(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector of the rows that take part."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    sound = (df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
             .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
             .where(F.forall("vector", number) & F.exists("vector", lambda x: x != 0)))
    lengths = sound.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("rows"))
    common = lengths.orderBy(F.col("rows").desc(), "length").limit(1)
    return sound.join(F.broadcast(common), F.size("vector") == F.col("length")).select("id", "vector")


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """id, vector, place, rep: of each vector's rows those with the ``keep`` smallest ids; rep
    numbers the vectors."""
    once = rows.withColumn("key", F.xxhash64("vector")).dropDuplicates(["key", "id", "vector"])
    own = Window.partitionBy("key", "vector")
    kept = once.withColumn("place", F.row_number().over(own.orderBy("id"))).where(F.col("place") <= keep)
    return stored(kept.withColumn("rep", F.min(F.monotonically_increasing_id()).over(own)).drop("key"), "distinct_vectors")


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def halved(points: np.ndarray, most: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers of the points in parts of at most ``most``, sizes within one of each other
    at every cut: cut at the median along the line between two means."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        part = open_.pop()
        if len(part) <= most:
            done.append(part)
            continue
        own = points[part]
        ends = own[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            side = squares(own, ends).argmin(1)
            if side.min() == side.max():
                break
            ends = np.stack([own[side == 0].mean(0), own[side == 1].mean(0)])
        order = np.argsort(own @ (ends[1] - ends[0]), kind="stable")
        open_ += [part[order[len(part) // 2:]], part[order[:len(part) // 2]]]
    return done


@dataclass
class Index:
    centroids: np.ndarray
    between: np.ndarray  # distances of the centroids
    neighbours: list[np.ndarray]
    entry: int
    least: float = 0.0  # nearer centroids than this count as this far, for the ratio
    ratio: float = 1.0

    def lists_of(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists that hold each vector, the nearest first."""
        return [x for at in range(0, len(vectors), ROWS) for x in self._lists_of(vectors[at:at + ROWS])]

    def _lists_of(self, vectors: np.ndarray) -> list[list[int]]:
        d = np.sqrt(squares(vectors, self.centroids))
        k = min(2 * REPLICAS, d.shape[1])
        near = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.tile(np.arange(k), (len(d), 1))
        own = np.take_along_axis(d, near, 1)
        order = np.lexsort((near, own), axis=1)
        near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
        out = []
        for c, x in zip(near.tolist(), own.tolist(), strict=True):
            chosen = [c[0]]
            for j in range(1, k):
                if x[j] > REPLICA_RATIO * x[0] or len(chosen) == REPLICAS:
                    break
                if all(self.between[i, c[j]] > APART * x[j] for i in chosen):
                    chosen.append(c[j])
            out.append(chosen)
        return out

    def reach(self, nearest: float) -> float:
        return self.ratio * max(nearest, self.least)

    def search(self, query: np.ndarray) -> list[int]:
        """The centroids within the ratio of the nearest one's distance, found best first
        along the graph."""
        def far(nodes) -> np.ndarray:
            return np.sqrt(((self.centroids[nodes] - query) ** 2).sum(1))

        seen = np.zeros(len(self.centroids), bool)
        seen[self.entry] = True
        first = float(far([self.entry])[0])
        frontier, found = [(first, self.entry)], []  # first: the distance of the nearest one so far
        nearest: list[float] = []  # of the visited ones, negated
        while frontier:
            d, node = heapq.heappop(frontier)
            if len(nearest) == VISITS and d > max(-nearest[0], self.reach(first)):
                break
            first = min(first, d)
            found.append((d, node))
            heapq.heappush(nearest, -d)
            if len(nearest) > VISITS:
                heapq.heappop(nearest)
            fresh = self.neighbours[node][~seen[self.neighbours[node]]]
            seen[fresh] = True
            for x, n in zip(far(fresh).tolist(), fresh.tolist(), strict=True):
                heapq.heappush(frontier, (x, n))
        return sorted(n for d, n in found if d <= self.reach(first))


def graph(between: np.ndarray, degree: int = DEGREE) -> list[np.ndarray]:
    """Neighbours of each centroid: near ones, unless one taken before is nearer to them; links
    go both ways, and one chain through all keeps the graph connected."""
    n = len(between)
    links: list[set[int]] = [set() for _ in range(n)]
    for i in range(n):
        taken: list[int] = []
        for j in np.argsort(between[i], kind="stable")[:4 * degree].tolist():
            if j != i and len(taken) < degree and all(between[j, t] > between[i, j] for t in taken):
                taken.append(j)
        for j in [*taken, *([i + 1] if i + 1 < n else [])]:
            links[i].add(j)
            links[j].add(i)
    return [np.array(sorted(x), np.int64) for x in links]


def fit(sample: np.ndarray, n_lists: int, nearest: int = NEAREST, recall: float = RECALL) -> Index:
    """Centroids, graph and ratio from the sampled vectors."""
    rng = np.random.default_rng(SEED)
    parts = halved(sample, max(1, math.ceil(len(sample) / n_lists)), rng)
    centroids = np.stack([sample[p].mean(0) for p in parts])
    between = np.sqrt(squares(centroids, centroids)).astype(np.float32)
    index = Index(centroids, between, graph(between), int(((centroids - centroids.mean(0)) ** 2).sum(1).argmin()))
    trials = rng.choice(len(sample), min(TRIALS, len(sample)), replace=False)
    far = squares(sample[trials], sample)
    far[np.arange(len(trials)), trials] = np.inf
    k = min(nearest, len(sample) - 1)
    if k <= 0:
        return index
    true = np.argpartition(far, k - 1, axis=1)[:, :k]
    of_lists = np.sqrt(squares(sample[trials], centroids))
    first = of_lists.min(1)
    index.least = float(np.quantile(first, 0.1))
    held = dict(zip((needed := np.unique(true)).tolist(), index.lists_of(sample[needed]), strict=True))
    ratios = [min(of_lists[q, held[int(x)]]) / max(first[q], index.least, 1e-300) for q in range(len(trials)) for x in true[q]]
    index.ratio = max(1.0, float(np.quantile(ratios, recall, method="higher")) * (1 + 1e-9))
    return index


def build(vectors: DataFrame, nearest: int = NEAREST, sample: int = SAMPLE, lists: int = LISTS, list_size: int = LIST_SIZE) -> Index | None:
    """The index for ``vectors`` (id, vector); None if there are none."""
    n = vectors.count()
    picked = vectors
    if n > sample:
        picked = vectors.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < math.floor((1 << 30) * sample / n)).limit(2 * sample)
    rows = picked.select("id", "vector").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.take(pa.array(np.argsort(rows.column("id").to_numpy(), kind="stable")))
    points = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows.num_rows, -1)
    return fit(points, max(1, min(lists, math.ceil(n / list_size), math.ceil(len(points) / 8))), nearest)


def nearest_in_block(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int,
                     masks: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query rows, point rows, distances): each query's k nearest points, ties to the smaller id,
    of those whose mask shares a bit with its own."""
    rough = squares(queries, points)
    if masks is not None:
        rough[(masks[0][:, None] & masks[1][None, :]) == 0] = np.inf
    most = np.partition(rough, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(rough), np.inf)
    slack = 1e-9 * ((queries * queries).sum(1) + (points * points).sum(1).max())
    rows, cols = np.nonzero((rough <= (most + slack)[:, None]) & np.isfinite(rough))
    exact = np.sqrt(((queries[rows] - points[cols]) ** 2).sum(1))
    order = np.lexsort((ids[cols], exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    near = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[near], cols[near], exact[near]


def shelves(lists: list[int]) -> dict[int, int]:
    """Shelf: mask of these lists on it."""
    out: dict[int, int] = {}
    for x in lists:
        out[x // SHELF] = out.get(x // SHELF, 0) | 1 << x % SHELF
    return out


def _shelved(of: DataFrame, choose, name: str) -> DataFrame:
    """``of`` (rep, id, vector) with a row for each shelf, and the mask, of the lists that
    ``choose(vectors)`` gives."""
    kinds = dict(of.dtypes)

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column("vector")
                points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                chosen = [shelves(x) for x in choose(points)]
                rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in chosen]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for c in chosen for x in c], pa.int32()), pa.array([m for c in chosen for m in c.values()], pa.int64()),
                     *(batch.column(c).take(rows) for c in kinds)], names=["shelf", "mask", *kinds])

    return stored(of.mapInArrow(deal, "shelf int, mask long, " + ", ".join(f"{c} {t}" for c, t in kinds.items())), name)


def search(df: DataFrame, is_query: Column, id_col: str = "id", vector_col: str = "vector", k: int = NEAREST,
           index: Index | None = None, block: int = BLOCK, group: int = GROUP, **sizes) -> DataFrame:
    """A row per query and neighbour found: query, rank, id, distance.  ``is_query`` is a
    condition on the column ``id``."""
    keep = k + 1
    rows = stored(clean(df, id_col, vector_col), "vectors")
    kept = distinct_vectors(rows, keep)
    firsts = kept.where("place = 1").select("rep", "id", "vector")
    index = index or build(firsts, k, **sizes)
    spark = df.sparkSession
    kind = dict(rows.dtypes)["id"]
    if index is None:
        return spark.createDataFrame([], f"query {kind}, rank int, id {kind}, distance double")
    sent = spark.sparkContext.broadcast(index)
    postings = _shelved(firsts, lambda points: sent.value.lists_of(points), "postings")
    known = firsts.select(F.xxhash64("vector").alias("key"), F.col("vector").alias("same"), "rep")
    asked = rows.where(is_query).dropDuplicates(["id", "vector"]).withColumn("key", F.xxhash64("vector"))
    queries = stored(asked.join(known, "key").where(F.col("vector") == F.col("same")).select(F.col("id").alias("query"), "rep", "vector"), "queries")
    once = queries.dropDuplicates(["rep"]).select("rep", "vector").repartition("rep")
    probes = _shelved(once, lambda points: [sent.value.search(p) for p in points], "probes")

    cuts = (postings.groupBy("shelf").agg(F.ceil(F.count("*") / block).alias("blocks"))
            .join(probes.groupBy("shelf").agg(F.ceil(F.count("*") / group).alias("groups")), "shelf"))
    cuts = F.broadcast(cuts)  # a row for each shelf, at most LISTS / SHELF
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    points = (postings.join(cuts, "shelf").withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "rep"), F.col("blocks")))
              .withColumn("group", spread("groups")).select("shelf", "block", "group", "mask", "rep", "id", "vector"))
    wanted = (probes.join(cuts, "shelf").withColumn("group", F.pmod(F.xxhash64(F.lit(SEED), "rep"), F.col("groups")))
              .withColumn("block", spread("blocks")).select("shelf", "block", "group", "mask", "rep", "vector"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"asked": [], "rep": [], "first": [], "distance": []})
        ids = right["id"].to_numpy()
        at, of, distance = nearest_in_block(matrix(left["vector"]), matrix(right["vector"]), ids, keep,
                                            (left["mask"].to_numpy(), right["mask"].to_numpy()))
        return pd.DataFrame({"asked": left["rep"].to_numpy()[at], "rep": right["rep"].to_numpy()[of], "first": ids[of], "distance": distance})

    keys = ["shelf", "block", "group"]
    near = wanted.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInPandas(compare, f"asked long, rep long, first {kind}, distance double")
    ranked = lambda df, by, *order: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    merged = near.groupBy("asked", "rep").agg(F.min("distance").alias("distance"), F.min("first").alias("first"))
    merged = ranked(merged, ["asked"], "distance", "first").where(F.col("rank") <= keep).drop("rank", "first")
    # the rows of the vectors found: the best are enough for all rows of the vector that asks
    found = ranked(merged.join(kept.select("rep", "id"), "rep"), ["asked"], "distance", "id").where(F.col("rank") <= keep).drop("rank")
    out = queries.select("query", F.col("rep").alias("asked")).join(found, "asked")
    own = (F.col("query") == F.col("id")) & (F.col("asked") == F.col("rep"))
    out = ranked(out.where(~own), ["query", "asked"], "distance", "id").where(F.col("rank") <= k)
    return out.select("query", "rank", "id", "distance")


ship(__name__)
