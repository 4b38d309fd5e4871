"""Row-level projections of the pipeline, as Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.text import WS, col, nullif_empty, py_strip, wikilink


def slug(name) -> Column:
    """ASCII-lower, non-[a-z0-9] runs to '-', trim '-', then cut to 60 chars."""
    lowered = F.translate(col(name), string.ascii_uppercase, string.ascii_lowercase)
    dashed = F.regexp_replace(lowered, "[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(dashed, "^-+|-+$", "")
    return F.substring(trimmed, 1, vocab.SLUG_MAX_CHARS)


def short_id(recording_id) -> Column:
    return F.substring(col(recording_id), 1, vocab.SHORT_ID_CHARS)


def date_prefix(start_at, created_at) -> Column:
    """Date part of the start time, or of the creation time when start is empty."""
    chosen = F.coalesce(nullif_empty(col(start_at)), col(created_at), F.lit(""))
    return F.substring_index(chosen, "T", 1)


def doc_key(start_at, created_at, name, recording_id) -> Column:
    return F.concat_ws("--", date_prefix(start_at, created_at), slug(name), short_id(recording_id))


def title_escape(name) -> Column:
    """Writer side: embed the name in double quotes, escaping '"' as '\\"'."""
    return F.concat(F.lit('"'), F.replace(col(name), F.lit('"'), F.lit('\\"')), F.lit('"'))


def title_unquote(value) -> Column:
    """Reader side: strip, then strip outer '"' characters (no unescaping)."""
    return F.regexp_replace(py_strip(value), r'\A"+|"+\z', "")


def has_summary(summary) -> Column:
    return F.length(F.coalesce(col(summary), F.lit(""))) > 0


def recorded_date(recorded_at, uploaded_at, run_date: str) -> Column:
    """recorded_at, else uploaded_at, else the run date; text before 'T'."""
    chosen = F.coalesce(nullif_empty(col(recorded_at)), nullif_empty(col(uploaded_at)))
    return F.coalesce(F.substring_index(chosen, "T", 1), F.lit(run_date))


def title_fallback(title, stem) -> Column:
    """A missing title falls back to the stem; an empty title stays empty."""
    return F.coalesce(col(title), col(stem))


def _head(value, chars: int | None) -> Column:
    """The text, or its first ``chars`` characters; NULL counts as empty."""
    whole = F.coalesce(col(value), F.lit(""))
    return whole if chars is None else F.substring(whole, 1, chars)


def summary_excerpt(summary, chars: int | None = None) -> Column:
    """The summary put into the prompt (the original's cut: vocab.SUMMARY_EXCERPT_CHARS)."""
    return _head(summary, chars)


def search_text(summary, transcript, chars: int | None = None) -> Column:
    """Summary, a blank line, the whole transcript (or its first ``chars``; the original
    searches vocab.SEARCH_TRANSCRIPT_CHARS); stripped."""
    return py_strip(F.concat(F.coalesce(col(summary), F.lit("")), F.lit("\n\n"), _head(transcript, chars)))


def delivery_text(summary, transcript, chars: int | None = None) -> Column:
    """Summary followed directly by the whole transcript (or its first ``chars``; the
    original searches vocab.DELIVERY_TRANSCRIPT_CHARS)."""
    return F.concat(F.coalesce(col(summary), F.lit("")), _head(transcript, chars))


def sync_flag(category) -> Column:
    return F.coalesce(col(category).isin(vocab.SYNC_BLOCKED), F.lit(False))


def prompt_text(title, excerpt) -> Column:
    return F.concat(
        F.lit("Title: "), col(title), F.lit("\n\nSummary excerpt:\n"),
        F.coalesce(nullif_empty(col(excerpt)), F.lit(vocab.NO_SUMMARY_PLACEHOLDER)))


def fence_strip(raw) -> Column:
    """Strip, remove code fences at line starts/ends, strip again."""
    inner = F.regexp_replace(py_strip(raw), rf"(?md)^```(?:json)?{WS}*|{WS}*```$", "")
    return py_strip(inner)


def reason_clean(reason, chars: int | None = None) -> Column:
    """Double quotes become single quotes; cut to ``chars`` if given (the original:
    vocab.REASON_MAX_CHARS)."""
    return F.replace(_head(reason, chars), F.lit('"'), F.lit("'"))


def wikilinks(names) -> Column:
    """'[[a]], [[b]]' from an array of names."""
    return F.array_join(F.transform(col(names), wikilink), ", ")


def bracket_list(names) -> Column:
    """'[a, b]' header rendering of a name list."""
    return F.concat(F.lit("["), F.array_join(F.coalesce(col(names), F.array()), ", "), F.lit("]"))


def checkbox_strip(item) -> Column:
    """Drop one leading '[ ]' / '[x]' / '[X]' and the whitespace after it."""
    return F.regexp_replace(col(item), rf"\A\[[ xX]\]{WS}*", "")
