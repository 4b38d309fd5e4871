"""Pages of many lines: the Markdown texts of entity pages, day files and queues.

Lines are range-partitioned by (page, order) and sorted within their partitions, so that a
page with a third of all lines is spread over as many tasks as it fills.  A line's place on
its page is its row number in its partition plus the lines of that page in the partitions
before: one small row for each page of a partition.  Parts hold ``part_lines`` lines each,
and a part is the largest thing that is ever gathered; a page is its parts in order.

Defined results: a page without lines doesn't exist; a null page name counts as the empty
one, null lines as empty lines; lines that repeat, repeat on their page; lines with equal
order keys stand by their text.  Parts depend on the lines alone, not on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.operators.sinks import write_vault
from recflow.session import stored

#: Lines of a part; a page of fewer lines is one part.
PART_LINES = 10_000


def _placed(picked: DataFrame, keys: list[Column], totals: dict | None = None) -> DataFrame:
    """(page, line, place): each line's place on its page, from 0; ``totals``: see ``pages``."""
    totals = totals or {}
    at = F.monotonically_increasing_id()
    placed = stored(picked.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .select("page", "line", *totals, F.shiftright(at, 33).alias("task"), at.alias("at")), "page-lines")
    runs = placed.groupBy("page", "task").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"),
                                              *(f(c).alias(c) for c, f in totals.items()))
    page = Window.partitionBy("page")
    before = page.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("page", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift"),
                       *(f(c).over(page).alias(c) for c, f in totals.items()))
    return (placed.drop(*totals).join(runs, ["page", "task"])
            .select("page", "line", *totals, (F.col("at") + F.col("shift")).alias("place")))


def pages(lines: DataFrame, page: str, line: str, order: list[Column], newest_first: bool = False,
          part_lines: int = PART_LINES, totals: dict | None = None) -> DataFrame:
    """(page, part, n_lines, body): the parts of each page; ``order`` are the columns that
    lines stand by, ``newest_first`` turns them (and the tie-break by text) round.  ``totals``
    (column: sum, min or max) are taken over whole pages, and every part of a page bears them."""
    def way(c: Column) -> Column:
        return c.desc() if newest_first else c.asc()

    totals = totals or {}
    names = [f"o{k}" for k in range(len(order))]
    picked = lines.select(F.coalesce(F.col(page).cast("string"), F.lit("")).alias("page"),
                          F.coalesce(F.col(line).cast("string"), F.lit("")).alias("line"), *totals,
                          *(c.alias(n) for c, n in zip(order, names, strict=True)))
    placed = _placed(picked, [F.col("page"), *(way(F.col(n)) for n in names), way(F.col("line"))], totals)
    gathered = F.array_sort(F.collect_list(F.struct("place", "line")))
    return (placed.withColumn("part", F.floor(F.col("place") / part_lines).cast("long"))
            .groupBy("page", "part", *totals).agg(F.count(F.lit(1)).alias("n_lines"), gathered.alias("found"))
            .select("page", "part", *totals, "n_lines", F.array_join(F.transform("found", lambda x: x["line"]), "\n").alias("body")))


def entity_pages(backlinks: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
    """Mentions under their heading, newest first; backlinks(entity, recorded_date, line)."""
    found = pages(backlinks, "entity", "line", [F.col("recorded_date")], newest_first=True, part_lines=part_lines)
    return found.select("page", "part", "n_lines", _text(F.lit("## Recent Mentions\n\n")).alias("text"))


def entity_history(mentions: DataFrame, key: str = "doc_key", part_lines: int = PART_LINES) -> DataFrame:
    """(entity, n_mentions, first_date, last_date, part, n_lines, lines): what stands on each
    entity's page, the line processed last first; mentions(entity, key, category, recorded_date, line).

    Documents are processed bucket by bucket, those of a bucket in the order of their keys.  Each
    line goes above those before it, and one that stands there already is not written again: it
    keeps its first place.  The numbers are those of all mentions of the entity, on each of its parts."""
    bucket = F.coalesce(F.array_position(F.array(*[F.lit(b) for b in vocab.BUCKETS]), F.col("category")), F.lit(0))
    written = mentions.groupBy("entity", "line").agg(
        F.min(F.struct(bucket.alias("bucket"), F.col(key).alias("key"))).alias("at"), F.count(F.lit(1)).alias("n_mentions"),
        F.min("recorded_date").alias("first_date"), F.max("recorded_date").alias("last_date"))
    totals = {"n_mentions": F.sum, "first_date": F.min, "last_date": F.max}
    found = pages(written, "entity", "line", [F.col("at.bucket"), F.col("at.key")], newest_first=True, part_lines=part_lines, totals=totals)
    return found.select(F.col("page").alias("entity"), *totals, "part", "n_lines", F.col("body").alias("lines"))


def day_pages(blocks: DataFrame, key: str = "doc_key", part_lines: int = PART_LINES,
              tags: str = "[action-items, transcript-derived]") -> DataFrame:
    """One file a recorded day, its documents' blocks in the order of their keys; blocks(recorded_date, key, block)."""
    found = pages(blocks, "recorded_date", "block", [F.col(key)], part_lines=part_lines)
    head = F.concat(F.lit("---\ndate: "), F.col("page"), F.lit(f"\ntype: action-items-rollup\ntags: {tags}\n---\n\n# Action Items — "),
                    F.col("page"), F.lit("\n\n"))
    return found.select("page", "part", "n_lines", _text(head).alias("text"))


def _text(head: Column) -> Column:
    return F.concat(F.when(F.col("part") == 0, head).otherwise(F.lit("")), F.col("body"), F.lit("\n"))


def file_stem(page: str = "page", part: str = "part") -> Column:
    """A page's first part bears its name, later ones a number; what ends a path is escaped."""
    name = F.regexp_replace(F.regexp_replace(F.col(page), "%", "%25"), "/", "%2F")
    name = F.when(name.startswith(".") | (name == ""), F.concat(F.lit("%"), name)).otherwise(name)
    return F.concat(name, F.when(F.col(part) > 0, F.concat(F.lit(" ("), (F.col(part) + 1).cast("string"), F.lit(")"))).otherwise(F.lit("")))


def write_pages(parts: DataFrame, root: str, folder: str) -> DataFrame:
    """Write each part as a file of its own from inside the tasks; (path, n_bytes) of each."""
    return write_vault(parts.select(F.lit(folder).alias("bucket"), file_stem().alias("stem"), "text"), root)


def changed_pages(all_lines: DataFrame, new_lines: DataFrame, page: str) -> DataFrame:
    """The lines of the pages that new lines stand on: what a run has to write again."""
    return all_lines.join(new_lines.select(page).distinct(), page, "left_semi")
