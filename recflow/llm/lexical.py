"""Ranked lexical search: every query item against all documents, over FP-trees of documents.

Documents are cut to the terms that some item asks for, ordered from the commonest to the
rarest.  A chunk of them becomes an FP-tree: documents that begin with the same terms share
the path, small subtrees are buckets of documents.  Each node keeps the largest tf of every
term in its subtree and the smallest m; with them the score formula bounds any document
below it, as it rises with tf and falls with m.  An item walks the tree depth first, the
most promising child first, and leaves out subtrees whose bound is below the worst of its
best documents so far.  What it reaches is scored exactly.

A task goes through its chunks one after the other and carries each item's best on; the
best of all tasks are ranked in the end.  Texts are read once for a block of items; a
block's terms are broadcast, and a block holds at most ``BLOCK_TERMS`` of them (or one item).

Defined results: null and empty texts have no terms, so neither score nor are found; rows
that repeat a document's id are documents of their own; rows that repeat an item's id are
items of their own; equal scores go by id, a null id last; an empty table gives no rows;
other columns of either table don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import ship, stored, text_of

BEST = 10
#: Documents in a tree, and in a bucket at its end.
CHUNK, BUCKET = 16_384, 32
#: Term numbers of a tree's documents, about: long documents make smaller trees.
CHUNK_TERMS = 4_000_000
#: Terms of a block of items, whose texts are read once; of a group of items that share a tree.
BLOCK_TERMS, GROUP_TERMS = 500_000, 8_192
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20
#: Term characters (digits, letters, all beyond ASCII), A-Z lower-cased; the others are blanks.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
                   for c in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, piece by piece."""
    plain, at = text.translate(TERM_BYTES), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(text: bytes | None) -> Counter:
    counts: Counter = Counter()
    for piece in pieces(text or b""):
        counts.update(piece)
    return counts


def _texts(df: DataFrame, text_col: str, **more) -> DataFrame:
    return df.select(*(c.alias(k) for k, c in more.items()), text_of(text_col).cast("binary").alias("text"))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """no, id, terms (distinct, sorted) of every item; written, so that the numbers stay."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(term_counts(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("no"), batch.column("id"), pa.array(found, pa.list_(pa.binary()))],
                                             names=["no", "id", "terms"])

    numbered = _texts(items, text_col, no=F.monotonically_increasing_id(), id=F.col(id_col))
    return stored(numbered.mapInArrow(cut, f"no long, id {dict(items.dtypes)[id_col]}, terms array<binary>"), "items")


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n, terms (numbers of the vocabulary), tfs of every document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = known.keys()
        for batch in batches:
            keep, sizes, terms, tfs = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                counts = term_counts(text.as_buffer().to_pybytes())
                if counts:
                    mine = names & counts.keys()
                    keep.append(row)
                    sizes.append(counts.total())
                    terms.append([known[t] for t in mine])
                    tfs.append([counts[t] for t in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])

    return stored(_texts(docs, text_col, id=F.col(id_col)).mapInArrow(
        cut, f"id {dict(docs.dtypes)[id_col]}, n long, terms array<int>, tfs array<long>"), "term_vectors")


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one occurrence pattern adds for a weight of 1; rises with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """FP-tree of documents given as rows of (ranks ascending, tfs), their m and ids.

    Equal rows are one entry with its ``best`` smallest ids, as no other can be among the
    best.  ``ptr``, ``rank``, ``tf`` hold the entries in the order of their paths."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], m: list[int], ids: list, width: int, best: int = BEST, bucket: int = BUCKET):
        entries: dict[tuple[bytes, bytes, int], list] = {}
        for (ranks, tfs), own_m, own_id in zip(rows, m, ids, strict=True):
            if len(ranks):
                held = entries.setdefault((ranks.astype(">u4").tobytes(), tfs.astype("<i8").tobytes(), own_m), [])
                held.append(own_id)
                if len(held) > 4 * best:
                    held[:] = sorted(held, key=id_order)[:best]
        order = sorted(entries)
        self.ids = [sorted(entries[e], key=id_order)[:best] for e in order]
        self.m = np.array([e[2] for e in order], np.int64)
        self.ptr = np.concatenate([[0], np.cumsum([len(e[0]) // 4 for e in order])]).astype(np.int64)
        self.rank = np.frombuffer(b"".join(e[0] for e in order), ">u4").astype(np.int64)
        self.tf = np.frombuffer(b"".join(e[1] for e in order), "<i8").astype(np.int64)
        self.gain = gain(self.tf, np.repeat(self.m, np.diff(self.ptr)))
        self._grow(bucket)
        self._summarise(width)

    def _grow(self, bucket: int) -> None:
        """Nodes in breadth-first order: low, high (entries), first and last child (0, 0: a bucket)."""
        self.low, self.high, self.first, self.last = [0], [len(self.m)], [0], [0]
        depths, at = [0], 0
        while at < len(self.low):
            low, high, depth = self.low[at], self.high[at], depths[at]
            if high - low > bucket:
                a, b = self.rank[self.ptr[low]:self.ptr[low + 1]], self.rank[self.ptr[high - 1]:self.ptr[high]]
                same = min(len(a), len(b))  # entries are sorted: what the outermost share, all share
                differ = np.flatnonzero(a[depth:same] != b[depth:same])
                depth = depth + int(differ[0]) if len(differ) else same
                length = np.diff(self.ptr[low:high + 1])
                here = np.where(length > depth, self.rank[np.minimum(self.ptr[low:high] + depth, len(self.rank) - 1)], -1)
                cuts = [0, *(np.flatnonzero(np.diff(here)) + 1).tolist(), high - low]
                if len(cuts) > 2:
                    self.first[at] = len(self.low)
                    start = 0
                    for k in range(1, len(cuts)):  # small neighbours share a bucket
                        if k + 1 < len(cuts) and cuts[k + 1] - start <= bucket:
                            continue
                        self.low.append(low + start)
                        self.high.append(low + cuts[k])
                        self.first.append(0)
                        self.last.append(0)
                        depths.append(depth)
                        start = cuts[k]
                    self.last[at] = len(self.low)
            at += 1

    def _summarise(self, width: int) -> None:
        """bound[node, rank]: the gain at the subtree's largest tf and smallest m."""
        n = len(self.low)
        most, least = np.zeros((n, width), np.int32), np.full(n, np.iinfo(np.int64).max)
        for node in range(n - 1, -1, -1):
            if self.last[node]:
                most[node] = most[self.first[node]:self.last[node]].max(axis=0)
                least[node] = least[self.first[node]:self.last[node]].min()
            elif self.high[node] > self.low[node]:
                part = slice(self.ptr[self.low[node]], self.ptr[self.high[node]])
                np.maximum.at(most[node], self.rank[part], np.minimum(self.tf[part], np.iinfo(np.int32).max).astype(np.int32))
                least[node] = self.m[self.low[node]:self.high[node]].min()
        for node in range(n):  # in place, row by row
            used = np.flatnonzero(most[node])
            tf = most[node, used].astype(np.int64)
            # a count beyond 32 bits was cut: the gain is below 1,000,000 for any count
            most[node, used] = np.where(tf == np.iinfo(np.int32).max, 1_000_000, gain(tf, least[node]))
        self.bound = most

    def search(self, ranks: np.ndarray, weights: np.ndarray, found: list, best: int = BEST) -> list:
        """``found`` (score, id), the best first, brought up to date with the tree's documents."""
        if not len(self.m) or not len(ranks):
            return found
        held = np.zeros(self.bound.shape[1], np.int64)
        held[ranks] = weights
        floor = found[-1][0] if len(found) == best else 1
        stack = [(int(self.bound[0, ranks].astype(np.int64) @ weights), 0)]
        while stack:
            bound, node = stack.pop()
            if bound < floor:
                continue
            if self.last[node]:
                first, last = self.first[node], self.last[node]
                bounds = self.bound[first:last][:, ranks].astype(np.int64) @ weights
                stack.extend((int(bounds[k]), first + int(k)) for k in np.argsort(bounds, kind="stable") if bounds[k] >= floor)
                continue
            low, high = self.low[node], self.high[node]
            start = self.ptr[low]
            part = slice(start, self.ptr[high])
            scores = np.add.reduceat(held[self.rank[part]] * self.gain[part], self.ptr[low:high] - start)
            for k in np.flatnonzero(scores >= floor):
                found.extend((int(scores[k]), x) for x in self.ids[low + int(k)])
            if len(found) > best:
                found.sort(key=lambda x: (-x[0], id_order(x[1])))
                del found[best:]
            if len(found) == best:
                floor = max(floor, min(x[0] for x in found))
        return found


def id_order(x) -> tuple:
    return (x is None, 0 if x is None else x)


def item_groups(items: list[tuple[int, list[bytes]]], most: int = GROUP_TERMS) -> list[list[tuple[int, list[bytes]]]]:
    """Items in groups of at most ``most`` distinct terms, or one item."""
    groups: list[list] = []
    held: set = set()
    for item in items:
        if not groups or len(held | set(item[1])) > most and held:
            groups.append([])
            held = set()
        groups[-1].append(item)
        held |= set(item[1])
    return groups


def _best_of_tasks(vectors: DataFrame, groups: list, total: tuple[int, int], best: int, chunk: int, bucket: int) -> DataFrame:
    """no, id, score: each task's best documents for each item.  ``groups``: (numbers of the
    terms from the commonest to the rarest, [(no, ranks, weights)]) for each group of items."""
    sent = vectors.sparkSession.sparkContext.broadcast((groups, total))
    kind = dict(vectors.dtypes)["id"]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, (n_docs, n_terms) = sent.value
        found: dict[int, list] = {}
        ids, sizes, terms, tfs, id_type, gathered = [], [], [], [], pa.int64(), 0

        def search() -> None:
            m = [10 + 90 * n * n_docs // n_terms for n in sizes]
            for order, queries in groups:
                place = np.full(max(int(order.max(initial=0)), max((int(t.max(initial=0)) for t in terms), default=0)) + 1, -1, np.int64)
                place[order] = np.arange(len(order))
                rows = []
                for t, f in zip(terms, tfs, strict=True):
                    p = place[t]
                    p, f = p[p >= 0], f[p >= 0]
                    by = np.argsort(p)
                    rows.append((p[by], f[by]))
                tree = Tree(rows, m, ids, len(order), best, bucket)
                for no, ranks, weights in queries:
                    found[no] = tree.search(ranks, weights, found.get(no, []), best)
            for held in (ids, sizes, terms, tfs):
                held.clear()

        for batch in batches:
            id_type = batch.schema.field("id").type
            values = [(batch.column(c).flatten().to_numpy(zero_copy_only=False), batch.column(c)) for c in ("terms", "tfs")]
            lengths = np.concatenate([[0], np.cumsum(np.fromiter((len(x) for x in values[0][1]), np.int64))])
            own_ids, own_sizes = batch.column("id").to_pylist(), batch.column("n").to_pylist()
            for k in range(batch.num_rows):
                part = slice(lengths[k], lengths[k + 1])
                ids.append(own_ids[k])
                sizes.append(own_sizes[k])
                terms.append(values[0][0][part])
                tfs.append(values[1][0][part].astype(np.int64))
                if len(ids) == chunk or lengths[k + 1] - lengths[0] + gathered >= CHUNK_TERMS:
                    search()
                    gathered = -int(lengths[k + 1] - lengths[0])
            gathered += int(lengths[-1] - lengths[0])
        if ids:
            search()
        rows = [(no, doc, score) for no, held in found.items() for score, doc in held]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], id_type),
                                              pa.array([r[2] for r in rows], pa.int64())], names=["no", "id", "score"])

    return vectors.where(F.size("terms") > 0).select("id", "n", "terms", "tfs").mapInArrow(rank, f"no long, id {kind}, score long")


def _block(docs: DataFrame, items: list[tuple[int, list[bytes]]], id_col: str, text_col: str, best: int, chunk: int, bucket: int) -> DataFrame:
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    vectors = term_vectors(docs, vocabulary, id_col, text_col)
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = {r["term"]: r["df"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    groups = []
    for group in item_groups(items):
        numbers = {vocabulary[t] for _, terms in group for t in terms} & held.keys()
        order = sorted(numbers, key=lambda t: (-held[t], t))
        rank = {t: k for k, t in enumerate(order)}
        queries = []
        for no, terms in group:
            mine = sorted(rank[vocabulary[t]] for t in terms if vocabulary[t] in rank)
            weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[order[r]] + 1))) for r in mine]
            queries.append((no, np.array(mine, np.int64), np.array(weights, np.int64)))
        groups.append((np.array(order, np.int64), queries))
    return _best_of_tasks(vectors, groups, (n_docs, n_terms), best, chunk, bucket)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", best: int = BEST, chunk: int = CHUNK, bucket: int = BUCKET, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """A row per item and document found: no (of the item's row), item, rank, id, score."""
    asked = item_terms(items, item_col, item_text_col)
    terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(terms / block_terms))
    out = None
    for block in range(blocks):
        of_block = [(r["no"], [bytes(t) for t in r["terms"]]) for r in
                    asked.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block).where(F.size("terms") > 0).select("no", "terms").collect()]
        found = _block(docs, sorted(of_block), id_col, text_col, best, chunk, bucket)
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(asked.select("no", F.col("id").alias("item")), "no").select("no", "item", "rank", "id", "score")


ship(__name__)
