"""Sources of the ingest stage: recorder listing, metadata blocks, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions.text import col

# POSIX [[:space:]] (awk/sed/grep) and awk's default field separators.
POSIX_SPACE = r"[ \t\n\x{0B}\f\r]"
LISTING_LINE = rf"^{POSIX_SPACE}+[0-9a-f]{{32}}"
METADATA_KEYS = ["name", "start_at", "created_at", "duration", "serial_number"]


def listing_ids(listing: DataFrame, value: str = "value", pos: str = "pos") -> DataFrame:
    """Data lines (indented, then 32 lowercase hex) -> first whitespace token.

    A token longer than 32 characters passes whole.  Keeps the line position
    so in-batch order survives.
    """
    first_field = F.regexp_extract(col(value), r"^[ \t]*([^ \t]+)", 1)
    return (listing.where(col(value).rlike(LISTING_LINE))
            .select(col(pos).alias("pos"), first_field.alias("recording_id")))


def explicit_ids(ids: DataFrame, id_col: str = "recording_id", pos: str | None = None) -> DataFrame:
    """Caller-supplied ids take the place of discovery (same gates follow)."""
    p = col(pos) if pos else F.monotonically_increasing_id()
    return ids.select(p.alias("pos"), col(id_col).alias("recording_id"))


def metadata_field(meta, key: str) -> Column:
    """Value of every ``  key:`` line (whitespace after the colon removed),
    joined by newlines, trailing newlines dropped; '' when absent."""
    lines = F.split(F.coalesce(col(meta), F.lit("")), "\n")
    prefix = f"  {key}:"
    vals = F.transform(F.filter(lines, lambda l: l.startswith(prefix)),
                       lambda l: F.regexp_replace(l, rf"^  {key}:{POSIX_SPACE}+", ""))
    return F.regexp_replace(F.array_join(vals, "\n"), r"\n+\z", "")


def valid_metadata(meta) -> Column:
    """A metadata block is usable only if it has a ``  name:`` line."""
    lines = F.split(F.coalesce(col(meta), F.lit("")), "\n")
    return F.exists(lines, lambda l: l.startswith("  name:"))


def metadata_fields(df: DataFrame, meta: str = "meta") -> DataFrame:
    """Adds the five metadata columns and ``meta_valid``."""
    cols = {("duration" if k == "duration" else k): metadata_field(meta, k) for k in METADATA_KEYS}
    cols["serial"] = cols.pop("serial_number")
    cols["meta_valid"] = valid_metadata(meta)
    return df.withColumns(cols)


def ledger_seed(docs: DataFrame, text: str = "text", id_key: str = "recording_id") -> DataFrame:
    """Rebuild the ledger from document text: lines ``<id_key>:<ws><32 hex>``.

    Mirrors grep -o + awk '{print $2}': the id is taken only when a blank or
    tab follows the colon (otherwise the second field is empty).
    """
    pattern = rf"(?m)^{id_key}:[ \t\x{{0B}}\f\r]*[0-9a-f]{{32}}"
    found = docs.select(F.explode(F.regexp_extract_all(col(text), F.lit(pattern), 0)).alias("m"))
    sep = F.substring(F.col("m"), len(id_key) + 2, 1)
    rid = F.when(sep.isin(" ", "\t"), F.substring(F.col("m"), -32, 32)).otherwise(F.lit(""))
    return found.select(rid.alias("recording_id")).distinct()


def inbox_ids(files: DataFrame, path: str = "file_name", text: str = "text", id_key: str = "recording_id") -> DataFrame:
    """Full ids of the documents still in the vault: files named ``*--<8 chars>.md`` (no
    sidecars), the id from the document's own header line."""
    base = F.substring_index(col(path), "/", -1)
    docs = files.where(base.rlike(r"(?s)--.{8}\.md\z"))
    return ledger_seed(docs, text, id_key).where(F.col("recording_id") != "")


def inbox_short_ids(files: DataFrame, path: str = "file_name") -> DataFrame:
    """Short ids of vault files named ``*--<8 chars>.md``."""
    base = F.substring_index(col(path), "/", -1)
    short = F.regexp_extract(base, r"(?s)--(.{8})\.md\z", 1)
    return files.select(short.alias("short_id")).where(F.col("short_id") != "").distinct()
