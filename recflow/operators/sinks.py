"""Sinks: rendered documents, partitioned writes and idempotent appends.

Plain Parquet has no MERGE, so every append is "new rows = candidates
left_anti existing rows on the natural key", then ``mode('append')``.  Writes
go to the shared folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import has_summary, title_escape, wikilinks
from recflow.functions.text import col, wikilink
from recflow.session import shared_dir
from recflow.sources.documents import file_systems


def write_partitioned(spark: SparkSession, df: DataFrame, name: str, partition_col: str,
                      path: str | None = None) -> str:
    """Write ``df`` partitioned by ``partition_col`` (e.g. one folder per category).

    Rows are clustered on the partition column with a REBALANCE hint: AQE
    keeps each category in few files but splits a category that holds a large
    share of the rows over several writer tasks (a plain repartition by the
    column would give a hot category a single task).  Dynamic partition
    overwrite replaces only the partitions written.
    """
    path = path or shared_dir(spark, name)
    (df.hint("rebalance", partition_col).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))
    return path


def append_new(candidates: DataFrame, existing: DataFrame | None, keys: list[str],
               prune_on: str | None = None) -> DataFrame:
    """Rows of ``candidates`` whose key is not already present (idempotent append).

    ``prune_on``: a partition column of the existing sink that is part of the
    key (e.g. the recorded day).  The sink is first semi-joined with the
    batch's distinct values, a join type dynamic partition pruning applies to,
    so only the partitions this batch can collide with are read."""
    fresh = candidates.dropDuplicates(keys)
    if existing is None:
        return fresh
    old = existing.select(*keys)
    if prune_on is not None:
        # pruning is only planned against a side with a comparison; this one holds for every day
        days = fresh.select(prune_on).where(F.col(prune_on).cast("string") >= "").distinct()
        old = old.join(days, prune_on, "left_semi")
    return fresh.join(old.dropDuplicates(keys), on=keys, how="left_anti")


def unified_document(df: DataFrame, pulled_at: str, source: str = "recorder",
                     id_key: str = "recording_id", serial_key: str = "recording_serial",
                     tags: str = "[transcript, recorder, capture]",
                     note: str = "> Pulled by the ingest job. Raw sidecars: `.transcript.txt`, `.summary.md`.") -> Column:
    """One Markdown text per recording: header, title, optional summary, transcript.

    Expects columns recording_id, serial, name, start_at, created_at,
    duration, summary, transcript.
    """
    nl = F.lit("\n")
    summ = has_summary("summary")
    header = F.concat(
        F.lit("---\n"),
        F.lit(f"source: {source}\n"),
        F.lit(f"{id_key}: "), col("recording_id"), nl,
        F.lit(f"{serial_key}: "), F.coalesce(col("serial"), F.lit("")), nl,
        F.lit("title: "), title_escape(F.coalesce(col("name"), F.lit(""))), nl,
        F.lit("recorded_at: "), F.coalesce(col("start_at"), F.lit("")), nl,
        F.lit("uploaded_at: "), F.coalesce(col("created_at"), F.lit("")), nl,
        F.lit("duration_human: "), F.coalesce(col("duration"), F.lit("")), nl,
        F.lit(f"pulled_at: {pulled_at}\n"),
        F.lit("pulled_via: ingest\n"),
        F.lit(f"ingestion_status: {vocab.STATUS_UNTRIAGED}\n"),
        F.lit("ai_summary: "), F.when(summ, F.lit("true")).otherwise(F.lit("false")), nl,
        F.lit(f"tags: {tags}\n"),
        F.lit("---\n"))
    body = F.concat(
        nl, F.lit("# "), F.coalesce(col("name"), F.lit("")), nl, nl,
        F.lit(note + "\n"), nl,
        F.when(summ, F.concat(F.lit("## AI Summary\n\n"), col("summary"), nl)).otherwise(F.lit("")),
        F.lit("## Transcript\n\n"),
        F.lit("```text\n"), F.coalesce(col("transcript"), F.lit("")), F.lit("```\n"))
    return F.concat(header, body)


def backlink_line(date, stem, title) -> Column:
    return F.concat(F.lit("- "), col(date), F.lit(" — "), wikilink(col(stem)), F.lit(" — "), col(title))


def candidate_line(date, stem, companies, title) -> Column:
    return F.concat(F.lit("- "), col(date), F.lit(" — "), wikilink(col(stem)),
                    F.lit(" — companies: "), wikilinks(col(companies)),
                    F.lit(" — title: "), col(title))


def rollup_block(stem, items) -> Column:
    """'## From [[stem]]' block with one unchecked box per item."""
    boxes = F.transform(col(items), lambda i: F.concat(F.lit("- [ ] "), i))
    return F.concat(F.lit("## From "), wikilink(col(stem)), F.lit("\n\n"),
                    F.array_join(boxes, "\n"), F.lit("\n"))


def audit_events(df: DataFrame, stage: str, ts: str, key: str, event: Column,
                 detail: Column | None = None) -> DataFrame:
    """One audit row per document: (ts, stage, doc_key, event, detail)."""
    return df.select(F.lit(ts).alias("ts"), F.lit(stage).alias("stage"), col(key).alias("doc_key"),
                     event.alias("event"),
                     (detail if detail is not None else F.lit("")).alias("detail"))


def audit_total(counts: DataFrame, stage: str, ts: str) -> DataFrame:
    """The batch row of a stage's audit: the one-row counts as ``name=value`` pairs."""
    pairs = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in counts.columns]
    return counts.select(F.lit(ts).alias("ts"), F.lit(stage).alias("stage"), F.lit("").alias("doc_key"),
                         F.lit("batch").alias("event"), F.concat_ws(" ", *pairs).alias("detail"))


def write_vault(df: DataFrame, root: str, bucket: str = "bucket", stem: str = "stem",
                text: str = "text", suffix: str = ".md") -> DataFrame:
    """Write one file ``<root>/<bucket>/<stem><suffix>`` per row from inside the
    tasks (pyarrow file system: local, HDFS or object store URIs).

    Returns (path, n_bytes) per written file; nothing passes through the driver.
    """
    import pandas as pd
    file_system = file_systems()

    def run(batches):
        filesystem, base = file_system(root)
        made = set()
        for pdf in batches:
            paths, sizes = [], []
            for b, s, t in zip(pdf[bucket], pdf[stem], pdf[text]):
                d = f"{base.rstrip('/')}/{b}"
                if d not in made:
                    filesystem.create_dir(d, recursive=True)
                    made.add(d)
                data = (t or "").encode("utf-8")
                with filesystem.open_output_stream(f"{d}/{s}{suffix}") as out:
                    out.write(data)
                paths.append(f"{d}/{s}{suffix}")
                sizes.append(len(data))
            yield pd.DataFrame({"path": paths, "n_bytes": sizes})

    return df.select(bucket, stem, text).mapInPandas(run, "path string, n_bytes long")


def write_enrich_sinks(result, root: str) -> dict:
    """Append an enrichment batch's new rows to day-partitioned sink tables
    (backlinks, rollup blocks, candidate lines) and its header patches to a
    new status snapshot.  Returns the paths."""
    paths = {n: f"{root.rstrip('/')}/{n}" for n in ("backlinks", "rollups", "candidates", "patches")}
    for name, df in (("backlinks", result.new_backlinks), ("rollups", result.new_blocks),
                     ("candidates", result.new_candidates)):
        df.hint("rebalance", "recorded_date").write.mode("append").partitionBy("recorded_date").parquet(paths[name])
    result.patches.write.mode("append").parquet(paths["patches"])
    return paths
