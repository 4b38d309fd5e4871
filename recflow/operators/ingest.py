"""Ingest (L1): dedup gates, in-batch order, pull outcome and counts.

All gates are anti/semi joins and aggregations; nothing is collected.  The gates
run over a batch's distinct ids; the in-batch rule "a later copy is skipped once
an earlier one was pulled" is the least position of an id that was pulled.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions.projections import short_id
from recflow.session import stored

PULLED, SKIPPED, FAILED = "pulled", "skipped", "failed"


def anti_ledger(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates whose id is not in the ledger (whole-line equality)."""
    return candidates.join(ledger.select("recording_id").distinct(), "recording_id", "left_anti")


def _gate(by_short_id: bool):
    """The column that names a recording still in the vault: its full id, or (the
    original's file-name test, under which distinct recordings can collide) the first
    8 characters."""
    return short_id("recording_id") if by_short_id else F.col("recording_id")


def anti_short_id(candidates: DataFrame, inbox: DataFrame, by_short_id: bool = False) -> DataFrame:
    """Candidates that name no document still in the vault: inbox(recording_id), or
    inbox(short_id) with ``by_short_id``."""
    s = inbox.select(F.col("short_id" if by_short_id else "recording_id").alias("_gate"))
    return candidates.withColumn("_gate", _gate(by_short_id)).join(s, "_gate", "left_anti").drop("_gate")


def batch_dedup(candidates: DataFrame) -> DataFrame:
    """First listing position of every id (later copies dropped)."""
    return candidates.groupBy("recording_id").agg(F.min("pos").alias("pos"))


def discovery_window(df: DataFrame, day_col, run_date: str, days: int) -> DataFrame:
    """Rows whose ISO day is ``run_date`` or one of the ``days`` days before it."""
    start = (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()
    d = F.col(day_col) if isinstance(day_col, str) else day_col
    return df.where((d >= F.lit(start)) & (d <= F.lit(run_date)))


def pull_outcome(candidates: DataFrame, ledger: DataFrame, inbox: DataFrame, metadata: DataFrame,
                 transcripts: DataFrame, by_short_id: bool = False) -> DataFrame:
    """Status per candidate line: skipped / failed / pulled.

    candidates(pos, recording_id); ledger(recording_id); inbox(recording_id), or
    inbox(short_id) with ``by_short_id``; metadata(recording_id, meta_valid, ...);
    transcripts(recording_id).  Several metadata rows of one id count as valid if one is.
    Failed pulls are not recorded anywhere, so they are retried next batch.

    Everything but the place of a line is a fact of its id, so the gates run over the
    batch's distinct ids (map-side combined, unique on both sides of every join) and the
    lookup tables are semi-joined with these first; one join then brings the status back
    to the lines.
    """
    # four gates and the status read the distinct ids: they are written once
    ids = stored(candidates.groupBy("recording_id").agg(F.min("pos").alias("_first")), "batch-ids")

    def only_batch(df: DataFrame) -> DataFrame:
        return df.join(ids.select("recording_id"), "recording_id", "left_semi")

    led = only_batch(ledger.select("recording_id")).distinct().withColumn("_in_ledger", F.lit(True))
    meta = (only_batch(metadata.select("recording_id", "meta_valid")).groupBy("recording_id")
            .agg(F.max("meta_valid").alias("_meta_ok")))
    tx = only_batch(transcripts.select("recording_id")).distinct().withColumn("_has_tx", F.lit(True))
    if by_short_id:
        here = inbox.select(F.col("short_id").alias("_gate"))
    else:
        here = only_batch(inbox.select("recording_id")).withColumnRenamed("recording_id", "_gate")
    here = here.distinct().withColumn("_in_inbox", F.lit(True))
    c = (ids.join(led, "recording_id", "left").join(meta, "recording_id", "left").join(tx, "recording_id", "left")
         .withColumn("_gate", _gate(by_short_id)).join(here, "_gate", "left"))
    base = (F.when(F.coalesce("_in_ledger", "_in_inbox", F.lit(False)), F.lit(SKIPPED))
             .when(~F.coalesce("_meta_ok", F.lit(False)), F.lit(FAILED))
             .when(~F.coalesce("_has_tx", F.lit(False)), F.lit(FAILED))
             .otherwise(F.lit(PULLED)))
    c = c.select("recording_id", "_gate", "_first", base.alias("_base"))
    if by_short_id:
        first = c.where(F.col("_base") == PULLED).groupBy("_gate").agg(F.min("_first").alias("_first_pulled"))
        c = c.join(first, "_gate", "left")
    else:
        c = c.withColumn("_first_pulled", F.when(F.col("_base") == PULLED, F.col("_first")))
    out = candidates.join(c.select("recording_id", "_base", "_first_pulled"), "recording_id")
    status = F.when(F.col("pos") > F.col("_first_pulled"), F.lit(SKIPPED)).otherwise(F.col("_base"))
    return out.select("pos", "recording_id", status.alias("status"))


def one_per_recording(metadata: DataFrame) -> DataFrame:
    """One metadata row per recording: a valid one before any other, then the latest by
    start and creation time, then the greatest by the remaining columns."""
    rest = [c for c in metadata.columns if c not in ("recording_id", "meta_valid", "start_at", "created_at")]
    best = F.max(F.struct("meta_valid", "start_at", "created_at", *rest)).alias("_m")
    return metadata.groupBy("recording_id").agg(best).select("recording_id", "_m.*")


def pull_counts(outcome: DataFrame) -> DataFrame:
    return outcome.agg(
        F.count_if(F.col("status") == PULLED).alias("pulled"),
        F.count_if(F.col("status") == SKIPPED).alias("skipped"),
        F.count_if(F.col("status") == FAILED).alias("failed"))


def ledger_append(outcome: DataFrame) -> DataFrame:
    """Ids to append to the ledger: only successful pulls."""
    return outcome.where(F.col("status") == PULLED).select("recording_id")
