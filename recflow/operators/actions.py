"""Action-item extraction from summaries, as array expressions.

Semantics (first match of a section heading, chunk to the next heading or
rule, dash/star bullets, strip + checkbox strip + noise filters; the bullet
label form only when the heading form yields nothing) are expressed with
regexp_extract / regexp_extract_all / transform / filter, so the whole
extraction runs inside codegen with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import checkbox_strip
from recflow.functions.text import WORD, WS, col, py_strip

_WS_INNER = WS[1:-1]
_HEAD_A = "|".join(vocab.ACTION_HEADING_WORDS_A)
_HEAD_B = "|".join(vocab.ACTION_HEADING_WORDS_B)

# Section start: a '##' heading (optionally quoted) naming the section, to its newline.
SECTION_A = rf"(?:^|\n)(?:##+|>?{WS}*##+){WS}*(?:{_HEAD_A})(?!{WORD})[^\n]*\n"
# Fallback: a bullet label such as '- Next Steps:' on its own line.
SECTION_B = rf"(?:^|\n)-{WS}*(?:{_HEAD_B}){WS}*:{WS}*\n"
# The chunk ends at the next heading or horizontal rule.
SECTION_END = rf"\n(?:##+|---){WS}"
BULLET = rf"(?md)^[{_WS_INNER}>]*[-*]{WS}+(.+)$"
ASSIGNEE = rf"\A@{WORD}[\p{{L}}\p{{N}}_{_WS_INNER}-]{{0,30}}\z"


def _section_chunk(summary: Column, start_pattern: str) -> tuple[Column, Column]:
    """(found, chunk): one scan splits the text at the first section start;
    the chunk then ends at the next heading or rule."""
    parts = F.split(summary, "(?iu)" + start_pattern, 2)
    found = F.size(parts) == 2
    chunk = F.regexp_replace(F.get(parts, 1), "(?s)" + SECTION_END + ".*", "")
    return found, chunk


def _section_items(summary: Column, start_pattern: str) -> Column:
    found, chunk = _section_chunk(summary, start_pattern)
    raw = F.regexp_extract_all(chunk, F.lit(BULLET), 1)
    cleaned = F.transform(raw, lambda b: py_strip(checkbox_strip(py_strip(b))))
    kept = F.filter(cleaned, lambda i: ~action_item_noise(i))
    return F.when(found, kept).otherwise(F.array().cast("array<string>"))


def action_item_noise(item) -> Column:
    """Placeholders, sub-section labels, bare @assignee headers, short lines."""
    i = col(item)
    return (F.lower(i).contains(vocab.ACTION_NOISE_PLACEHOLDER)
            | F.lower(i).endswith(":")
            | i.rlike(ASSIGNEE)
            | (F.length(i) < vocab.ACTION_MIN_CHARS))


def action_items(summary) -> Column:
    """ARRAY<STRING> of action items of one summary."""
    s = F.coalesce(col(summary), F.lit(""))
    a = _section_items(s, SECTION_A)
    b = _section_items(s, SECTION_B)
    return F.when(F.size(a) > 0, a).otherwise(b)


def action_item_rows(df: DataFrame, key: str = "doc_key", items: str = "items") -> DataFrame:
    """One row per item with its position: (key, pos, item)."""
    return df.select(key, F.posexplode(items).alias("pos", "item"))


def daily_rollup(items_df: DataFrame, day: str = "recorded_date", key: str = "doc_key") -> DataFrame:
    """Per recorded day: documents with a block and items (partial aggregation)."""
    return items_df.groupBy(day).agg(
        F.count_distinct(key).alias("n_blocks"), F.count(F.lit(1)).alias("n_items"))


def section_bullets(summary, which: str = "A") -> Column:
    """Cleaned bullets of the first heading-form (A) or label-form (B) section,
    before the noise filters (for inspection and tuning)."""
    s = F.coalesce(col(summary), F.lit(""))
    found, chunk = _section_chunk(s, SECTION_A if which == "A" else SECTION_B)
    raw = F.regexp_extract_all(chunk, F.lit(BULLET), 1)
    return F.when(found, raw).otherwise(F.array().cast("array<string>"))
