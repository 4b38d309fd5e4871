"""Exact dedup: an extendible-hash index on shared files.

Texts are keyed by a 64-bit hash of the normalised text.  A directory of the hash's
leading bits, made from the keys, doubles until no bucket holds more distinct keys than its
capacity; sibling slots that fit together share a bucket (local depth below the global
depth).  Every text is looked up in the directory and goes to its bucket; within a bucket
the entries of one key form a chain and are told apart by their bytes, with map-side
combining, so that copies of a text, however many, leave each task as one row.  The index is
written range-partitioned by bucket and key, so each owner file holds a key range, and every
document finds its group there by bucket, key and digest.  What the directory doesn't hold
has no group: a wrong directory gives wrong results (tested).

The directory has at most 2 ** ``MAX_DEPTH`` slots of three numbers and is sent to all
tasks; beyond that many buckets, buckets hold more, which changes no result.

Only DataFrame functions are used.  Defined results: null text counts as empty and empty
texts are copies of each other; of equal texts the smallest id stays, null ids after all
others; rows that repeat both id and text count singly in group_size and are all marked
kept, and ``drop_copies`` keeps one of them; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import SPACES, packed, stored, text_of, unpacked

#: Distinct entries that a bucket may hold before it splits.
CAPACITY = 65_536
#: Doublings of the directory at most, which bounds what is sent to the tasks (2 million slots).
MAX_DEPTH = 21


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(text_of(text_col), SPACES, " ")


def _prefix(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit key."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(key, 64 - depth)


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[int, DataFrame]:
    """Global depth and the slots: ``slot``, ``bucket`` (its first slot), ``local_depth``.

    ``keys`` holds distinct ``key`` values.  Doubling goes on until the fullest slot fits;
    equal keys can't be split and count once, their chain is within the bucket."""
    total = keys.count()
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, total / capacity)))))
    while depth < MAX_DEPTH:
        fullest = (keys.groupBy(_prefix(F.col("key"), depth).alias("slot")).count().agg(F.max("count"))).first()[0]
        if not fullest or fullest <= capacity:
            break
        depth += 1
    slots = stored(keys.groupBy(_prefix(F.col("key"), depth).alias("slot")).agg(F.count("*").alias("n")), "slots")
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    levels = levels.withColumn("group", F.expr(f"shiftright(slot, cast({depth} - level as int))"))
    fits = levels.groupBy("level", "group").agg(F.sum("n").alias("n")).where(F.col("n") <= capacity)
    local = (levels.drop("n").join(fits, ["level", "group"]).groupBy("slot").agg(F.min("level").alias("local_depth")))
    return depth, local.select("slot", "local_depth", F.expr(
        f"shiftleft(shiftright(slot, cast({depth} - local_depth as int)), cast({depth} - local_depth as int))").alias("bucket"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                using: Callable[[DataFrame, int], tuple[int, DataFrame]] = directory) -> tuple[DataFrame, DataFrame]:
    """(entries, index).  ``entries``: a row per document with its bucket, key and digest.
    ``index``: a row per distinct text: bucket, local_depth, key, digest, keep_id, group_size.
    ``using`` makes the directory from the distinct keys."""
    norm = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm")).withColumn("key", F.xxhash64("norm"))
    scanned = stored(norm.select("id", "key", F.unhex(F.sha2("norm", 256)).alias("digest")), "entries")
    depth, slots = using(stored(scanned.select("key").distinct(), "keys"), capacity)
    slots = F.broadcast(stored(slots, "directory"))

    def in_buckets(rows: DataFrame) -> DataFrame:
        return rows.withColumn("slot", _prefix(F.col("key"), depth)).join(slots, "slot").drop("slot")

    chains = (in_buckets(norm).groupBy("bucket", "local_depth", "key", "norm")
              .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")))
    texts = stored(chains.select("bucket", "local_depth", "key", F.unhex(F.sha2("norm", 256)).alias("digest"), "keep_id", "group_size"), "texts")
    index = stored(texts.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "digest"), "index")
    entries = scanned.withColumn("slot", _prefix(F.col("key"), depth)).join(slots, "slot", "left").drop("slot", "local_depth")
    return entries, index


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 using: Callable[[DataFrame, int], tuple[int, DataFrame]] = directory) -> DataFrame:
    """A row per document: id, keep_id, group_size, kept, digest (hex)."""
    entries, index = build_index(docs, id_col, text_col, capacity, using)
    # a text found once is its own group, so only chains of copies are looked up
    copies = index.where("group_size > 1").select("bucket", "key", "digest", "keep_id", "group_size", F.lit(True).alias("found"))
    keep = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("id"))
    return (entries.join(copies, ["bucket", "key", "digest"], "left")
            .select("id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("digest")))


def _mark(id_col: Column, digest: Column) -> Column:
    """Hash of an id, null too, and its text's hexadecimal digest."""
    return F.unhex(F.sha2(F.concat(digest, F.coalesce(F.concat(F.lit(":"), id_col.cast("string")), F.lit(""))), 256))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    dropped = stored(exact_groups(docs, id_col, text_col).where(~F.col("kept"))
                     .select(_mark(F.col("id"), F.col("digest")).alias("mark")).distinct(), "dropped")
    # an id that repeats, null too, may have a copy and a text of its own; the documents move once, for both steps
    once = packed(docs, mark=_mark(F.col(id_col), F.sha2(normalised(text_col), 256))).dropDuplicates(["mark"])
    return unpacked(once.join(dropped, "mark", "left_anti"))
