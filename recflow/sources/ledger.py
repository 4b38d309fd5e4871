"""A growing set of ids, and what is kept of each, in segments, each with a Bloom sketch.

A batch that asks which of its ids are known reads the sketches, then only the segments that
may hold one of its ids, and compares exactly.  Segments are written whole under a number of
the caller's choice, so that a batch that is replayed replaces its own; segments of one size
are merged from time to time, so that their number grows with the logarithm of the ids.

A sketch has a power of two of bits, ``BITS`` or more for an id, of which an id sets
``PROBES``; the share of foreign ids that pass is about one in a million, so that a batch of
many thousands seldom reads a segment in vain.  What passes by chance costs a read and
changes no result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recflow.sources.documents import path_exists

BITS, PROBES, FAN = 32, 12, 8


def folders(spark: SparkSession, path: str) -> dict[str, bool]:
    """Names of the folders in a folder, and whether they were written to the end."""
    jvm = spark.sparkContext._jvm
    here = jvm.org.apache.hadoop.fs.Path(path)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(here):
        return {}
    found = [x.getPath() for x in fs.listStatus(here) if x.isDirectory()]
    return {x.getName(): fs.exists(jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS")) for x in found}


def remove(spark: SparkSession, path: str) -> None:
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(here, True)


def _probes(key: str, size: Column) -> Column:
    """The places of an id in a sketch of 2 ** size bits, as (word, bit) structs."""
    left = lambda x, n: F.call_function("shiftleft", x, n)
    mask = left(F.lit(1).cast("long"), size) - 1

    def place(i: Column) -> Column:
        return F.xxhash64(i, F.col(key)).bitwiseAND(mask)

    return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(PROBES - 1).cast("long")), lambda i: F.struct(
        F.shiftright(place(i), 6).alias("word"), left(F.lit(1).cast("long"), place(i).bitwiseAND(F.lit(63)).cast("int")).alias("bit")))


class Ledger:
    """Ids under ``root``: ``data/seg=N`` and ``sketch/seg=N_S`` (S: the binary logarithm of its
    bits).  A segment counts once its sketch is written.  ``more``: columns kept with an id."""

    def __init__(self, spark: SparkSession, root: str, key: str = "recording_id", kind: str = "string", more: str = ""):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schema = f"{key} {kind}, {more}" if more else f"{key} {kind}"
        self.columns = StructType.fromDDL(self.schema).names

    def segments(self) -> dict[int, int]:
        """Number and size of every segment."""
        done = [n for n, whole in folders(self.spark, f"{self.root}/sketch").items() if whole and n.startswith("seg=")]
        return {int(n[4:].split("_")[0]): int(n.split("_")[1]) for n in done}

    def _data(self, numbers) -> DataFrame:
        paths = [f"{self.root}/data/seg={n}" for n in sorted(numbers)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def ids(self) -> DataFrame:
        return self._data(self.segments()).select(self.key).distinct()

    def append(self, ids: DataFrame, number: int) -> None:
        """Write the ids as segment ``number``, in place of what it held; of an id's rows one is kept."""
        path = f"{self.root}/data/seg={number}"
        for size in [s for n, s in self.segments().items() if n == number]:
            remove(self.spark, f"{self.root}/sketch/seg={number}_{size}")
        (ids.select(*self.columns).where(F.col(self.key).isNotNull()).dropDuplicates([self.key])
         .write.mode("overwrite").parquet(path))
        held = self.spark.read.schema(self.schema).parquet(path)
        size = max(6, math.ceil(math.log2(max(1, held.count()) * BITS)))
        bits = (held.select(F.inline(_probes(self.key, F.lit(size)))).groupBy("word").agg(F.bit_or("bit").alias("bits")))
        bits.write.mode("overwrite").parquet(f"{self.root}/sketch/seg={number}_{size}")

    def may_hold(self, ids: DataFrame, before: int | None = None) -> list[int]:
        """Segments whose sketch has all places of some id; no others can hold one.  ``before``:
        only segments of lower numbers, as a run that is repeated doesn't count its own."""
        segments = {n: s for n, s in self.segments().items() if before is None or n < before}
        if not segments:
            return []
        sizes = sorted(set(segments.values()))
        sketch = None
        for number, size in sorted(segments.items()):
            part = (self.spark.read.schema("word long, bits long").parquet(f"{self.root}/sketch/seg={number}_{size}")
                    .select(F.lit(number).alias("seg"), F.lit(size).alias("size"), "word", "bits"))
            sketch = part if sketch is None else sketch.unionByName(part)
        asked = (ids.select(self.key).distinct().withColumn("size", F.explode(F.array(*map(F.lit, sizes))))
                 .select(self.key, "size", F.inline(_probes(self.key, F.col("size"))))
                 .groupBy(self.key, "size", "word").agg(F.bit_or("bit").alias("mask")))
        words = asked.groupBy(self.key, "size").agg(F.count("*").alias("words"))
        met = (asked.join(sketch, ["size", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
               .groupBy(self.key, "size", "seg").agg(F.count("*").alias("met")))
        hit = met.join(words, [self.key, "size"]).where("met = words").select("seg").distinct()
        return sorted(r["seg"] for r in hit.collect())  # at most the number of segments

    def candidates(self, ids: DataFrame, before: int | None = None) -> DataFrame:
        """What the segments that may hold some of ``ids`` hold."""
        return self._data(self.may_hold(ids, before))

    def unseen(self, ids: DataFrame) -> DataFrame:
        """The rows of ``ids`` whose id the ledger doesn't hold."""
        return ids.join(self.candidates(ids).select(self.key).distinct(), self.key, "left_anti")

    def compact(self, fan: int = FAN, before: int | None = None) -> None:
        """Merge segments of one size, ``fan`` or more, into one; a loss on the way leaves ids
        in two segments at most, which changes nothing.  ``before``: only segments of lower numbers."""
        while True:
            by_size: dict[int, list[int]] = {}
            for number, size in self.segments().items():
                if before is None or number < before:
                    by_size.setdefault(size, []).append(number)
            full = next((sorted(x) for _, x in sorted(by_size.items()) if len(x) >= fan), None)
            if full is None:
                return
            last = full[-1]
            sizes = self.segments()
            # the merged segment takes the negative number of its last one: no batch has that
            self.append(self._data(full), -abs(last) - 1 if last >= 0 else min(sizes) - 1)
            for number in full:
                remove(self.spark, f"{self.root}/sketch/seg={number}_{sizes[number]}")
                remove(self.spark, f"{self.root}/data/seg={number}")


def exists(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root.rstrip('/')}/sketch")
