"""Trie of conversations: every distinct sequence of first turns is a node, with totals of its subtree.

Conversations are rebuilt first: conversation c begins with the first h turns of conversation
c - c % 100 and goes on with its own turns after its first h (``rebuilt``).  A prefix is named
by 144 bits, the sums of a digest for every place and turn, so that names of prefixes, and of
their parents, are running sums.  Grouping by name gives the nodes.

Subtree totals come by time-forward processing.  Nodes are sorted in reverse level order, the
deepest first; each sends its totals to its parent through a priority queue in that order,
which writes sorted runs to disk beyond a set number of messages.  Subtrees of at most
``shard`` turns are shards, dealt to tasks; the totals of their roots are summed by parent
and go through the same process once more for the nodes above them, in one task: these are
at most (turns / shard) on each level, and shard grows with the square root of the turns.

Positions within a conversation, and its running sums, come from bounded parts of it, so that
no task needs to hold a conversation.  The ids that end at a node are hashed as a stream, in
order, from pieces that other tasks have joined.

Defined results: a null or empty role or text is the empty text; a null turn comes first; turns
of one number go by the digest of role and text; a row without conv_id belongs to no
conversation; a conversation without rebuilt turns ends at the root; an empty table gives no
nodes; other columns don't matter.  A conversation may have up to 250 million turns.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import ship, stored, text_of

#: Turns of the base conversation that one begins with: 0 to HEADS - 1; conversations of one base.
HEADS, FAMILY = 6, 100
#: Running sums are cut into chunks of so many turns.
CHUNK = 8_192
#: Turns in a shard, at least; messages that a queue holds in memory, runs on disk; ids in a piece.
SHARD, HELD, RUNS, PIECE = 1_000, 200_000, 64, 8_192
#: Parts of a name, and bits of each.
PARTS, BITS = 3, 48
ROOT = bytes(PARTS * BITS // 8)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), digest, chars: ``turns`` (conv, turn, role, text) in their order."""
    keyed = turns.select("conv", "turn", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
                         F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("turn").asc_nulls_first(), "digest", "tie"]
    ranged = stored(keyed.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    sizes = ranged.groupBy("conv", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = ranged.withColumn("within", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)))
    return stored(within.join(sizes, ["conv", "part"]).select("conv", (F.col("before") + F.col("within")).alias("pos"), "digest", "chars"),
                  "numbered_turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, d (from 1), digest, chars, total; conv, total) of the rebuilt conversations."""
    numbered = numbered_turns(turns)
    conv = F.col("conv")
    lengths = numbered.groupBy("conv").agg(F.max("pos").alias("own"))
    plan = lengths.select("conv", "own", (conv - conv % FAMILY).alias("base"), (F.crc32(conv.cast("string")) % HEADS).alias("h"))
    heads = numbered.where((conv % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "base")
    bases = lengths.where(conv % FAMILY == 0).select(F.col("conv").alias("base"), F.col("own").alias("of_base"))
    plan = (plan.join(bases, "base", "left")
            .withColumn("head", F.least("h", F.coalesce("of_base", F.lit(0))))
            .withColumn("total", F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h")))
            .select("conv", "base", "h", "head", "total"))
    plan = stored(plan, "rebuilt_plan")
    first = plan.join(heads, "base").where(F.col("pos") <= F.col("h")).select("conv", F.col("pos").alias("d"), "digest", "chars", "total")
    rest = (numbered.join(plan, "conv").where(F.col("pos") > F.col("h"))
            .select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("d"), "digest", "chars", "total"))
    return first.unionByName(rest), plan.select("conv", "total")


def _name(sums: list[Column]) -> Column:
    """The name of a prefix: its sums, each modulo 2 ** BITS."""
    return F.unhex(F.concat(*(F.lpad(F.hex(s.bitwiseAND(F.lit((1 << BITS) - 1))), BITS // 4, "0") for s in sums)))


def paths(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv, d, name, parent, chars, total: the prefix that each turn of ``rebuilt`` completes."""
    digest = F.sha2(F.concat_ws(":", "d", "digest"), 256)
    own = members.withColumn("place", digest)
    own = own.select("*", *(F.conv(F.substring("place", 1 + k * BITS // 4, BITS // 4), 16, 10).cast("long").alias(f"t{k}") for k in range(PARTS)))
    own = own.withColumn("chunk", F.floor((F.col("d") - 1) / chunk)).drop("place", "digest")
    names = [f"t{k}" for k in range(PARTS)]
    whole = (own.where(F.col("total") > chunk).groupBy("conv", "chunk")
             .agg(*(F.sum(t).bitwiseAND(F.lit((1 << BITS) - 1)).alias(t) for t in names)))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select("conv", "chunk", *(F.sum(t).over(earlier).alias(f"o{k}") for k, t in enumerate(names)))
    upto = Window.partitionBy("conv", "chunk").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    sums = own.select("conv", "chunk", "d", "chars", "total", *names, *(F.sum(t).over(upto).alias(f"s{k}") for k, t in enumerate(names)))
    sums = sums.join(offsets, ["conv", "chunk"], "left")
    upto_here = [F.coalesce(F.col(f"o{k}"), F.lit(0)) + F.col(f"s{k}") for k in range(PARTS)]
    return stored(sums.select("conv", "d", _name(upto_here).alias("name"),
                              _name([s - F.col(t) for s, t in zip(upto_here, names, strict=True)]).alias("parent"), "chars", "total"), "paths")


class SpillingQueue:
    """Messages (depth, name, counts) in reverse level order: deepest first, then by name.

    Beyond ``held`` messages those in memory are written to disk as a sorted run; what is
    taken is the least of memory and the runs' heads."""

    RECORD = f">q{len(ROOT)}sqqq"

    def __init__(self, held: int = HELD, runs: int = RUNS):
        self.held, self.most_runs, self.heap = held, runs, []
        self.runs, self.written = [], 0  # (next message, run's number, its further messages)

    def push(self, depth: int, name: bytes, *counts: int) -> None:
        heapq.heappush(self.heap, (-depth, name, *counts))
        if len(self.heap) > self.held:
            if len(self.runs) == self.most_runs:  # few files are open at a time
                merged = heapq.merge(*(self._all(head, rest) for head, _, rest in self.runs))
                self.runs = []
                self._write(merged)
            self._write(sorted(self.heap))
            self.heap.clear()

    def _all(self, head: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
        yield head
        yield from rest

    def _write(self, messages: Iterable[tuple]) -> None:
        run = tempfile.TemporaryFile(prefix="queue-")  # noqa: SIM115  read by this task only, gone with it
        for message in messages:
            run.write(struct.pack(self.RECORD, *message))
        run.seek(0)
        self.written += 1
        self._head(self.written, self._read(run))

    def _read(self, run) -> Iterator[tuple]:
        with run:
            while record := run.read(struct.calcsize(self.RECORD) * 1024):
                yield from struct.iter_unpack(self.RECORD, record)

    def _head(self, number: int, reader: Iterator[tuple]) -> None:
        if (message := next(reader, None)) is not None:
            heapq.heappush(self.runs, (message, number, reader))

    def take(self, depth: int, name: bytes) -> Iterator[tuple[int, int, int]]:
        """Counts of the messages to this node, which leave the queue."""
        key = (-depth, name)
        while self.heap and self.heap[0][:2] == key:
            yield heapq.heappop(self.heap)[2:]
        while self.runs and self.runs[0][0][:2] == key:
            message, number, reader = heapq.heappop(self.runs)
            self._head(number, reader)
            yield message[2:]


def time_forward(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """Nodes in reverse level order with their totals: children, leaves and saved are increased
    by those that the children in the same stream send; a node that is ``label`` sends nothing."""
    queue = SpillingQueue(held)
    for batch in batches:
        columns = {k: batch.column(k).to_pylist() for k in ("d", "name", "parent", "label", "n_convs", "chars", "children", "leaves", "saved")}
        for row, (depth, name, parent, label, n, chars, *_) in enumerate(zip(*columns.values(), strict=True)):
            children, leaves, saved = (columns[k][row] for k in ("children", "leaves", "saved"))
            for count, below, tokens in queue.take(depth, name):
                children, leaves, saved = children + count, leaves + below, saved + tokens
            leaves = leaves if children else 1
            saved += (n - 1) * chars
            for k, v in (("children", children), ("leaves", leaves), ("saved", saved)):
                columns[k][row] = v
            if name != label and depth:
                queue.push(depth - 1, parent, 1, leaves, saved)
        out = [pa.array(columns[c], pa.int64()) if c in ("children", "leaves", "saved") else batch.column(c) for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(out, names=batch.schema.names)


def _forward(nodes: DataFrame, held: int) -> DataFrame:
    """``nodes``, dealt to tasks, through ``time_forward``."""
    ordered = nodes.sortWithinPartitions(F.col("d").desc(), "name")
    return ordered.mapInArrow(lambda batches: time_forward(batches, held), ordered.schema)


def _ends(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """name, ends_sha256: of the ids, ascending and joined by commas, that end at each node.

    ``ends`` (name, conv) are dealt by ranges and joined piece by piece; the pieces of a node
    are hashed one after the other."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        name, held = None, []
        for batch in batches:
            out: list[tuple] = []
            for own, conv in zip(batch.column("name").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if held and (own != name or len(held) == piece):
                    out.append((name, held[0], ",".join(map(str, held))))
                    held = []
                name = own
                held.append(conv)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else ((), (), ()), schema.types, strict=True)],
                                             schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((name, held[0], ",".join(map(str, held))), schema.types, strict=True)],
                                             schema=schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.binary()), ("ends_sha256", pa.string())])
        name, running = None, None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(schema.types)], schema=schema)

        for batch in batches:
            out = []
            for own, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != name:
                    if running is not None:
                        out.append((name, running.hexdigest()))
                    name, running = own, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield batch_of(out)
        if running is not None:
            yield batch_of([(name, running.hexdigest())])

    pieces = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(join, "name binary, first long, ids string")
    return (pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
            .mapInArrow(digest, "name binary, ends_sha256 string"))


def build(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          shard: int | None = None, held: int = HELD, chunk: int = CHUNK, piece: int = PIECE) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text"))
    members, convs = rebuilt(turns)
    path = paths(members, chunk)
    n_turns = path.count()
    shard = shard or max(SHARD, math.isqrt(n_turns))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("d"), F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), "conv", "n_convs",
        F.lit(0).cast("long").alias("chars"), F.lit(None).cast("long").alias("turns"))
    below = path.groupBy(F.col("d").cast("long").alias("d"), "name", "parent").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.sum(F.col("total") - F.col("d") + 1).alias("turns"))
    nodes = stored(below.unionByName(root), "trie_nodes")

    # a node is above the shards if its members have more than ``shard`` turns from it on
    above = stored(nodes.where(F.col("turns").isNull() | (F.col("turns") > shard)), "trie_above")
    depths = path.join(above.select("name"), "name", "left_semi").groupBy("conv").agg(F.max("d").alias("cut"))
    labels = (path.join(depths, "conv", "left").where(F.col("d") == F.coalesce("cut", F.lit(0)) + 1)
              .select(F.col("conv").alias("member"), F.col("name").alias("label")))
    zero = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    light = nodes.where(F.col("turns") <= shard).join(labels, F.col("conv") == F.col("member"))
    light = light.select("d", "name", "parent", "label", "conv", "n_convs", "chars", *zero).repartition("label")
    light = stored(_forward(light, held), "trie_shards")
    roots = (light.where(F.col("name") == F.col("label")).groupBy(F.col("parent").alias("to"))
             .agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    top = above.join(roots, F.col("name") == F.col("to"), "left").select(
        "d", "name", "parent", F.lit(None).cast("binary").alias("label"), "conv", "n_convs", "chars",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("children", "leaves", "saved")))
    done = light.unionByName(_forward(top.repartition(1), held))

    ends = path.where(F.col("d") == F.col("total")).select("name", "conv").unionByName(
        convs.where("total = 0").select(F.lit(ROOT).alias("name"), "conv"))
    done = (done.join(nodes.select(F.col("name").alias("up"), F.col("conv").alias("parent_conv_id")), F.col("parent") == F.col("up"), "left")
            .join(_ends(ends, piece).withColumnRenamed("name", "ending"), F.col("name") == F.col("ending"), "left"))
    return done.select(F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
                       F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


ship(__name__)
