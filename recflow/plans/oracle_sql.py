"""DuckDB (RE2) building blocks for the oracle SQL.

RE2 has no lookaround, so word boundaries are written as consuming
``(?:^|[^W])`` / ``(?:[^W]|$)`` groups; that is exact for existence tests.
Python's whitespace set is spelled out the same way as on the JVM side.
"""

from __future__ import annotations

from recflow.functions import vocab

DW = r"[\p{L}\p{N}_]"
DNW = r"[^\p{L}\p{N}_]"
DWS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def sq(s: str) -> str:
    """SQL string literal (DuckDB: no backslash escapes)."""
    return "'" + s.replace("'", "''") + "'"


def words_re(words: list[str]) -> str:
    return "(?i)(?:^|" + DNW + ")(?:" + "|".join(words) + ")(?:" + DNW + "|$)"


def category_case(title: str) -> str:
    parts = ["CASE"]
    for category, _b, words in vocab.ROUTING_RULES:
        parts.append(f" WHEN regexp_matches(coalesce({title}, ''), {sq(words_re(words))}) THEN {sq(category)}")
    parts.append(f" ELSE {sq(vocab.FALLBACK_CATEGORY)} END")
    return "".join(parts)


def blocked_case(category: str) -> str:
    names = ", ".join(sq(c) for c, b, _ in vocab.ROUTING_RULES if b)
    return f"coalesce({category} IN ({names}), false)"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {sq(r'\A' + DWS + '+|' + DWS + r'+\z')}, '', 'g')"


def nullif_empty(x: str) -> str:
    return f"nullif({x}, '')"
