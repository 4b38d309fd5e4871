"""DuckDB expressions for header parsing, used by the oracle SQL."""

from __future__ import annotations

from recflow.plans.oracle_sql import py_strip, sq

HEADER = r"(?s)\A---\n(.*?)\n---\n"
LB = r"[\n\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def has_header(t: str) -> str:
    return f"coalesce(regexp_matches({t}, {sq(HEADER)}), false)"


def lines(t: str) -> str:
    return (f"(CASE WHEN {has_header(t)} THEN string_split_regex(regexp_extract({t}, {sq(HEADER)}, 1), {sq(LB)}) "
            f"ELSE []::VARCHAR[] END)")


def unquote(v: str) -> str:
    return f"regexp_replace({py_strip(v)}, {sq(r'\A\"+|\"+\z')}, '', 'g')"


def after_colon(l: str) -> str:
    return f"regexp_replace({l}, '^[^:]*:', '')"


def entries(t: str) -> str:
    """list of struct(key, value) in header order (skips no-colon / indented lines)."""
    return (f"list_transform(list_filter({lines(t)}, lambda l: strpos(l, ':') > 0 AND NOT starts_with(l, '  ')), "
            f"lambda l: {{'key': {py_strip('split_part(l, chr(58), 1)')}, 'value': {unquote(after_colon('l'))}}})")


def header_get(t: str, key: str) -> str:
    """Value of the last header line with this key (NULL if none)."""
    return f"(list_filter({entries(t)}, lambda e: e.key = {sq(key)})[-1]).value"


def header_title(t: str, stem: str) -> str:
    first = f"list_filter({lines(t)}, lambda l: starts_with(l, 'title:'))[1]"
    return f"coalesce({unquote(after_colon(first))}, {stem})"
