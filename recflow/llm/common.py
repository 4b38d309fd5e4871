"""Helpers shared by the corpus operators.

Every operator picks the columns it needs by name and works on private names, so
extra columns of its input, whatever they are called, never clash with its own.
"""

from __future__ import annotations

import contextlib
import functools
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.session import shared_dir

#: White space of the contracts: space, and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ship(module_name: str) -> None:
    """Send the module's functions to the workers by value, so that workers need not
    have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back: later plans
    start from the files, and a lost executor costs no recomputation of what led there."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    if _in_stage:
        _scratch.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Scratch tables of the running or last stage of a pipeline.
_scratch: list[str] = []
_in_stage = False


def stage(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage of a pipeline, ``function(spark, docs, sf_dir)``.  Its predecessor's rows are
    written by the time it begins and come as ``docs``, so the predecessor's scratch tables
    go first, unless ``docs`` still reads them."""
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _in_stage
        if _scratch:
            read_now = docs.inputFiles()
            for path in _scratch:
                if not any(path in file for file in read_now):
                    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
            _scratch.clear()
        _in_stage = True
        try:
            return function(spark, docs, sf_dir)
        finally:
            _in_stage = False
    return run


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Within it, texts go to the Python workers in Arrow batches of this size at most.  A
    task holds a batch several times over, in the JVM and in its worker, and by default one
    is 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole rows as the struct ``row`` beside these columns: whatever names the rows
    have, none clashes.  ``unpacked`` gives the rows back."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    return df.select(row, *(c.alias(name) for name, c in columns.items()))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


ship(__name__)
