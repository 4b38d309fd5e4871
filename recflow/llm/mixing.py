"""Mixing sources to target weights.

Every source's words, its documents in a pseudorandom order, are packed into blocks of a
fixed number of words (the last may be short).  A source's target fixes how many of its
slots the mix has; the output shards draw how many slots each has of each source (multinomial
counts, given the totals), and running sums make these ranges of slots.  Slot j of a source is mapped through a pseudorandom
permutation of the source's block indexes (one for each pass over the source) and joined
with the block of that index.  The last slot of a source is cut so that the words taken
are its rounded target.

Only DataFrame functions are used.  Offsets within a source come from sums by bounded
chunks of documents, so that no task holds a source.  Defined results: null text has size 0
and nothing of it is taken; null is a source of its own, the last; rows that repeat an id
are documents of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import WORD, packed, stored, text_of, unpacked

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 256
SHARD_SLOTS = 1024
#: Documents in a chunk, about; slots that one row of the slot plan stands for.
CHUNK_DOCS, PLAN_SLOTS = 10_000, 8_192
ROUNDS = 16
#: Bits of the fractions that decide on a document's further copy.
STEP_BITS = 32
SEED = 20_240_607


def permuted(x: Column, n: Column, key: Column, seed: int = SEED, back: bool = False) -> Column:
    """``x`` in 0..n-1 through a pseudorandom permutation of 0..n-1: swap-or-not rounds, each
    its own inverse, so ``back`` runs them in the reverse order."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), key, r), n) + n - at, n)
        swap = F.xxhash64(F.lit(seed + 1), key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(rounds, x.cast("long"), step)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """A row per source: source, source_no, source_size, weight, target.

    ``sizes`` has source and source_size.  Sources fill in proportion to their weights until
    they reach ``most`` times their size; in the order of size to weight, the level is the
    first that the remaining sources can't reach."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("source_no", F.row_number().over(in_order).cast("long"))
    picked = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    numbered = numbered.withColumn("weight", picked).withColumn("cap", most * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levelled = (numbered.withColumn("at", F.row_number().over(fill))
                .withColumn("level", (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                            / F.sum("weight").over(after)))
    short = F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct("at", "level"))
    return (levelled.withColumn("filled", F.min(short).over(everything)["level"])
            .withColumn("target", F.least("cap", F.coalesce(F.col("filled") * F.col("weight"), F.col("cap"))))
            .select("source", "source_no", "source_size", "weight", "target"))


def _plan(sources: DataFrame, block: int) -> DataFrame:
    """Adds n_blocks, passes (whole ones), last_slots and last_cut of the part pass, and slots."""
    size, b = F.col("source_size"), F.lit(block).cast("long")
    planned = F.round("target").cast("long")
    plan = (sources.withColumn("n_blocks", F.ceil(size / block).cast("long"))
            .withColumn("passes", F.when(size > 0, F.floor(planned / size)).otherwise(0).cast("long"))
            .withColumn("rest", planned - F.col("passes") * size)
            .withColumn("gap", F.col("n_blocks") * b - size))
    # where the short block stands in the part pass
    stands = F.when(F.col("n_blocks") > 0, permuted(F.col("n_blocks") - 1, F.greatest("n_blocks", F.lit(1)),
                                                    F.concat_ws(":", "source_no", "passes"), back=True))
    plan = plan.withColumn("stands", stands)
    slots = F.when(F.col("rest") <= F.col("stands") * b, F.ceil(F.col("rest") / block)).otherwise(
        F.ceil((F.col("rest") + F.col("gap")) / block))
    plan = plan.withColumn("last_slots", F.when(F.col("rest") > 0, slots).otherwise(0).cast("long"))
    done = (F.col("last_slots") - 1) * b - F.when(F.col("stands") < F.col("last_slots") - 1, F.col("gap")).otherwise(0)
    return (plan.withColumn("last_cut", F.when(F.col("last_slots") > 0, F.col("rest") - done))
            .withColumn("slots", F.col("passes") * F.col("n_blocks") + F.col("last_slots")))


def shard_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, source_no, first, count: the slots that each output shard has of each source.

    A source's slots are dealt to the shards at random, one by one: the counts are a
    multinomial draw, given the source's total.  ``first`` is their running sum, so that a
    shard's slots of a source are consecutive."""
    shards = F.greatest(F.lit(1), F.ceil(F.sum("slots").over(Window.partitionBy()) / shard_slots)).cast("long")
    parts = (plan.select("source_no", "slots", shards.alias("shards")).where("slots > 0")
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / PLAN_SLOTS)))))
    first = F.col("part") * PLAN_SLOTS
    # a set number of tasks, which the few bytes of the plan don't get merged into one
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (parts.repartition(tasks, "source_no", "part")
             .withColumn("slot", F.explode(F.sequence(first, F.least(first + PLAN_SLOTS, "slots") - 1))))
    drawn = (dealt.groupBy("source_no", F.pmod(F.xxhash64(F.lit(SEED + 2), "source_no", "slot"), F.col("shards")).alias("shard"))
             .agg(F.count("*").alias("count")))
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return drawn.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0))).select("shard", "source_no", "first", "count")


def draw(plan: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """A row per slot of the mix: shard, place (orders a shard), source_no, block, cut (words
    of the block taken; null: all)."""
    # written, as a window over a source leaves few tasks; the slots are made by all of them
    counts = stored(shard_counts(plan, shard_slots), "shard_counts")
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = (counts.repartition(tasks, "source_no", "shard").join(plan, "source_no")
             .withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1))))
    turn = F.floor(F.col("slot") / F.col("n_blocks")).cast("long")
    return (slots.withColumn("turn", turn)
            .select("shard", F.xxhash64(F.lit(SEED + 3), "source_no", "slot").alias("place"), "source_no",
                    permuted(F.col("slot") % F.col("n_blocks"), F.col("n_blocks"),
                             F.concat_ws(":", "source_no", "turn")).alias("block"),
                    F.when(F.col("slot") == F.col("slots") - 1, F.col("last_cut")).alias("cut")))


def numbered_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, in_files: bool = False) -> DataFrame:
    """number, row (the whole row), id, text, source.  A row's number is its place in the
    files; documents that aren't rows ``in_files`` as they stand are written first."""
    whole = docs if in_files else stored(docs, "numbered")
    at = whole.metadataColumn("_metadata")
    file, place = at.getField("file_path"), at.getField("row_index")
    number = F.struct(F.xxhash64(file).alias("file"), F.hash(file).alias("more"), place.alias("place"))
    of = lambda c: F.col(f"`{c}`")
    return packed(whole, number=number, id=of(id_col), text=of(text_col), source=of(source_col))


def place_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents with row, id, tie, source_no, size, start within the source; sources)."""
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    sized = stored(docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), text_of(text_col).alias("text"))
                   .select("row", "id", "source", F.xxhash64("text").alias("tie"),
                           F.regexp_count("text", F.lit(WORD)).cast("long").alias("size")), "sizes")
    sources = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    chunks = max(1, math.ceil(sized.count() / CHUNK_DOCS))
    numbered = (sized.join(sources.select(F.col("source").alias("s"), "source_no"), F.col("source").eqNullSafe(F.col("s")))
                .select("row", "id", "size", "tie", "source_no", F.pmod(F.xxhash64(F.lit(SEED), "id", "tie"), F.lit(chunks)).alias("chunk")))
    sums = numbered.groupBy("source_no", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("chunk_start"))
    within = (Window.partitionBy("source_no", "chunk").orderBy(F.xxhash64(F.lit(SEED + 4), "id", "tie"), "id", "tie", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (numbered.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(sums, ["source_no", "chunk"])
              .select("row", "id", "tie", "source_no", "size", (F.col("chunk_start") + F.col("before")).alias("start")))
    return stored(placed, "placed"), sources


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Documents cut at block borders: row, source_no, block, low and high within the block,
    skip (words of the document before the piece)."""
    end = F.col("start") + F.col("size")
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    at = F.col("block") * block
    return cut.select("row", "id", "source_no", "block", (F.greatest("start", at) - at).alias("low"),
                      (F.least(end, at + block) - at).alias("high"), (F.greatest("start", at) - F.col("start")).alias("skip"))


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block: int = BLOCK, row_col: str | None = None) -> DataFrame:
    """A row per document: row, id, tie, size, source_no, source_size, target, taken."""
    placed, sources = place_documents(docs, id_col, text_col, source_col, row_col)
    drawn = (draw(_plan(sources, block)).groupBy("source_no", "block")
             .agg(F.count(F.when(F.col("cut").isNull(), 1)).alias("times"), F.max("cut").alias("cut")))
    part = F.greatest(F.lit(0), F.least("high", "cut") - F.col("low"))
    # the draws come from a small table by explode, so that their size is underestimated: never broadcast
    taken = (pieces(placed, block).join(drawn.hint("merge"), ["source_no", "block"])
             .groupBy("row").agg(F.sum(F.col("times") * (F.col("high") - F.col("low"))
                                       + F.when(F.col("cut").isNull(), 0).otherwise(part)).alias("taken")))
    return (placed.join(taken, "row", "left").join(sources.drop("source", "weight"), "source_no")
            .select("row", "id", "tie", "size", "source_no", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK) -> DataFrame:
    """A row per document: id, size, source_no, source_size, target, taken."""
    return taken_words(docs, id_col, text_col, source_col, block).drop("row", "tie")


def mixed_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 block: int = BLOCK) -> DataFrame:
    """The mix itself: shard, place, source_no, block, text of the words taken."""
    whole = numbered_rows(docs, id_col, text_col, source_col)
    placed, sources = place_documents(whole, "id", "text", "source", "number")
    words = whole.select(F.col("number").alias("row"), F.regexp_extract_all(text_of("text"), F.lit(WORD), 0).alias("words"))
    cut = (pieces(placed, block).join(words, "row")
           .select("source_no", "block", "low", F.expr("slice(words, cast(skip + 1 as int), cast(high - low as int))").alias("words")))
    blocks = (cut.groupBy("source_no", "block").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("low", "words"))), lambda x: x["words"])).alias("words")))  # at most one block of words
    return (draw(_plan(sources, block)).hint("merge").join(blocks, ["source_no", "block"])
            .select("shard", "place", "source_no", "block", F.array_join(F.when(F.col("cut").isNull(), F.col("words")).otherwise(
                F.slice("words", F.lit(1), F.col("cut").cast("int"))), " ").alias("text")))


def copies(placed: DataFrame) -> DataFrame:
    """``placed`` (row, id, tie, source_no, size, taken) with ``times``, how many whole copies its rows get.

    A document gets the whole part of taken / size and one more with the rest as probability,
    so that its expected words are those taken, whatever its length.  The rests of documents
    of one source and about one length, in the order of size, are added up from a random
    start, and the sum's steps over whole numbers give the further copies: so the words of a
    stratum miss those taken by no more than about one document of it."""
    placed = stored(placed, "taken")
    chunks = max(1, math.ceil(placed.count() / CHUNK_DOCS))
    rest = F.when(F.col("size") > 0, F.floor((F.col("taken") % F.col("size")) * F.lit(float(1 << STEP_BITS)) / F.col("size"))).otherwise(0)
    strata = (placed.withColumn("whole", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0))
              .withColumn("rest", rest.cast("long")).withColumn("stratum", F.floor(F.log2(F.col("size") + 1)))
              .withColumn("chunk", F.pmod(F.xxhash64(F.lit(SEED + 5), "id", "tie"), F.lit(chunks))))
    at = (Window.partitionBy("source_no", "stratum", "chunk").orderBy("size", F.xxhash64(F.lit(SEED + 6), "id", "tie"), "id", "tie", "row")
          .rowsBetween(Window.unboundedPreceding, -1))
    begin = F.pmod(F.xxhash64(F.lit(SEED + 7), "source_no", "stratum", "chunk"), F.lit(1 << STEP_BITS))
    before = F.coalesce(F.sum("rest").over(at), F.lit(0)) + begin
    further = F.shiftright(F.col("before") + F.col("rest"), STEP_BITS) - F.shiftright(F.col("before"), STEP_BITS)
    return strata.withColumn("before", before).withColumn("times", (F.col("whole") + further).cast("int")).drop(
        "whole", "rest", "stratum", "chunk", "before")


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             in_files: bool = False) -> DataFrame:
    """The documents of the mix with all their columns: whole ones, so often that each one's
    expected words are those taken (none, once or twice).  ``in_files``: ``docs`` are the rows
    of files as they stand, so that their places in the files number them; others are written."""
    whole = numbered_rows(docs, id_col, text_col, source_col, in_files)
    drawn = (copies(taken_words(whole, "id", "text", "source", row_col="number")).where("times > 0")
             .select(F.col("row").alias("drawn"), "times"))
    return unpacked(whole.select("number", "row").join(stored(drawn, "drawn"), F.col("number") == F.col("drawn"))
                    .select("row", F.explode(F.sequence(F.lit(1), F.col("times")))))
