"""A sketch of many keys that is small enough for every task: what none of the keys can be
goes where a table is read, before a join shuffles it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch has 32 bits or more for a key, and 2 ** 27 bits (16 MB) at most.
BITS, MOST = 32, 27


def sketched(rows: DataFrame, keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """``rows`` without most of those whose ``key`` is none of ``keys``, which has the column
    too: a bit for each key, in rows of 32,768 bits that are sent to the tasks (16 MB in all at
    most, however many keys).  What passes by chance is left to the exact join that follows."""
    size = min(MOST, max(15, math.ceil(math.log2(max(1, n_keys) * BITS))))
    def marked(df: DataFrame) -> DataFrame:  # each key is hashed once
        return df.withColumn("_at", F.xxhash64(key).bitwiseAND(F.lit((1 << size) - 1)))

    at = F.col("_at")
    word = F.shiftright(at, 6).bitwiseAND(F.lit(511)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    words = (marked(keys).select(F.shiftright(at, 15).alias("_row"), word.alias("word"), bit.alias("bit"))
             .groupBy("_row", "word").agg(F.bit_or("bit").alias("bits")))
    held = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("_held"))
    none = F.lit(0).cast("long")
    sketch = held.select("_row", F.transform(F.sequence(F.lit(0), F.lit(511)), lambda i: F.coalesce(F.col("_held")[i], none)).alias("_bits"))
    near = marked(rows).join(F.broadcast(sketch), F.shiftright(at, 15) == F.col("_row"))
    return near.where(F.get("_bits", word).bitwiseAND(bit) != 0).select(*rows.columns)
