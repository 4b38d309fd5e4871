"""The documents' state as a snapshot and a log of patches, merged when read.

Each stage appends a patch: for some documents the new values of some columns, under a
number that rises from patch to patch; the same number written again replaces its patch, so
that a replayed stage changes nothing.  The value of a column is that of the latest patch
that sets it, or the snapshot's.  ``compact`` writes the merged state as a new snapshot.

Snapshots keep settled documents (enriched ones) in a folder of their own.  ``pending`` reads
the others and the log, and of the settled ones only those that a later patch touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recflow.functions import vocab
from recflow.sources.ledger import folders, remove

SETS = "_sets"


class StatusTable:
    """``base/upto=N`` (all patches up to N merged) and ``log/seq=N`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str = "recording_id", is_open: Column | None = None):
        """``is_open``: which documents aren't settled (default: all but enriched ones)."""
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.is_open = F.col("status").isNull() | (F.col("status") != vocab.STATUS_ENRICHED) if is_open is None else is_open
        self.columns = [f.name for f in StructType.fromDDL(schema) if f.name != key]
        self.schema = schema

    def _numbers(self, folder: str, name: str) -> list[int]:
        return sorted(int(n.split("=")[1]) for n, whole in folders(self.spark, f"{self.root}/{folder}").items()
                      if whole and n.startswith(f"{name}="))

    def patch(self, rows: DataFrame, number: int) -> None:
        """``rows``: the key and the columns that the patch sets, one row per document."""
        sets = [c for c in rows.columns if c != self.key]
        kinds = {f.name: f.dataType for f in StructType.fromDDL(self.schema)}
        rows.select(self.key, F.array(*map(F.lit, sets)).alias(SETS),
                    *((F.col(c) if c in sets else F.lit(None)).cast(kinds[c]).alias(c) for c in self.columns)
                    ).write.mode("overwrite").parquet(f"{self.root}/log/seq={number:012d}")

    def has(self, number: int) -> bool:
        """Whether this patch was written to the end."""
        return number in self._numbers("log", "seq")

    def _upto(self) -> int:
        return max(self._numbers("base", "upto"), default=-1)

    def _base(self) -> DataFrame:
        upto = self._upto()
        if upto < 0:
            return self.spark.createDataFrame([], f"{self.schema}, open boolean")
        return self.spark.read.schema(f"{self.schema}, open boolean").parquet(f"{self.root}/base/upto={upto:012d}")

    def _log(self, before: int | None = None) -> DataFrame:
        """key, and for each column the struct (seq, value) of the latest patch that sets it."""
        upto = self._upto()
        patches = None
        for n in self._numbers("log", "seq"):
            if n > upto and (before is None or n < before):
                part = (self.spark.read.schema(f"{self.schema}, {SETS} array<string>").parquet(f"{self.root}/log/seq={n:012d}")
                        .withColumn("_seq", F.lit(n)))
                patches = part if patches is None else patches.unionByName(part)
        if patches is None:
            patches = self.spark.createDataFrame([], f"{self.schema}, {SETS} array<string>, _seq int")
        latest = [F.max(F.when(F.array_contains(SETS, c), F.struct("_seq", F.col(c).alias("value")))).alias(c) for c in self.columns]
        return patches.groupBy(self.key).agg(*latest)

    def _merged(self, base: DataFrame, log: DataFrame) -> DataFrame:
        both = base.alias("b").join(log.alias("p"), F.col(f"b.{self.key}") == F.col(f"p.{self.key}"), "full_outer")
        value = lambda c: F.when(F.col(f"p.{c}").isNotNull(), F.col(f"p.{c}.value")).otherwise(F.col(f"b.{c}")).alias(c)
        return both.select(F.coalesce(F.col(f"b.{self.key}"), F.col(f"p.{self.key}")).alias(self.key), *map(value, self.columns))

    def read(self, before: int | None = None) -> DataFrame:
        """Every document's current state; ``before``: as the patches of lower numbers leave
        it, which is what a repeated stage must see."""
        return self._merged(self._base(), self._log(before))

    def pending(self, before: int | None = None) -> DataFrame:
        """The documents that aren't settled.  Of the snapshot's settled documents only those
        are read that a later patch touches."""
        log, base = self._log(before), self._base()
        whole = F.lit(True)
        for c in self.columns:
            whole = whole & F.col(c).isNotNull()
        again = base.where("NOT open").join(log.where(~whole).select(self.key), self.key, "left_semi")
        return self._merged(base.where("open").unionByName(again), log).where(self.is_open)

    def compact(self) -> None:
        """A new snapshot of all patches; the one before stays until the next, for its readers."""
        last = max(self._numbers("log", "seq"), default=-1)
        upto = self._upto()
        if last <= upto:
            return
        (self.read().withColumn("open", self.is_open).hint("rebalance", "open").write.mode("overwrite")
         .partitionBy("open").parquet(f"{self.root}/base/upto={last:012d}"))
        for n in self._numbers("base", "upto"):
            if n < upto:
                remove(self.spark, f"{self.root}/base/upto={n:012d}")
        for n in self._numbers("log", "seq"):
            if n <= upto:
                remove(self.spark, f"{self.root}/log/seq={n:012d}")
