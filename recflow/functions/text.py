"""Text expression helpers that give Python-``re`` semantics on the JVM.

Java regexes differ from Python's in what counts as whitespace, word
characters and line ends.  The classes below spell Python's behaviour out so
that every pattern in the library means the same thing on every executor.
All helpers return Columns: they compile into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's \w for str patterns: letters, numbers and underscore (no marks).
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"
# Python's \s / str.isspace() set.
WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set as characters (for trim, which strips any of them).
PY_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
               + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")
# Python's \b, written out (Java's \b treats combining marks as word chars).
BOUNDARY = rf"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"
# Line breaks str.splitlines() honours once \r has been normalised away.
LINE_BREAK = r"[\n\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace.

    ``trim`` with an explicit character set only touches the ends, unlike a
    regex that is tried at every position of a long text."""
    return F.trim(col(c), F.lit(PY_WS_CHARS))


def words_pattern(words: list[str]) -> str:
    """Case-insensitive whole-word alternation with Python ``\\b`` semantics."""
    return "(?iu)" + BOUNDARY + "(?:" + "|".join(words) + ")" + BOUNDARY


def quote_literal(c) -> Column:
    """Column expression: ``\\Q<text>\\E`` with embedded ``\\E`` escaped."""
    return F.concat(F.lit(r"\Q"), F.replace(col(c), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def name_pattern(c) -> Column:
    """Whole-name, case-insensitive pattern for an entity name column.

    Python's \\b at the ends of a fixed name reduces to one look-around: before
    a word character the previous one must not be a word character, before a
    non-word character it must be one (mirrored at the end).  A single cheap
    check per text position instead of the general two-sided boundary."""
    name = col(c)
    q = quote_literal(c)
    # the start check is a fixed-length lookbehind placed after the literal,
    # so a position costs one character compare unless the name begins there
    pre = F.when(name.rlike(rf"\A{WORD}"), F.concat(F.lit(f"(?<!{WORD}"), q, F.lit(")"))) \
        .otherwise(F.concat(F.lit(f"(?<={WORD}"), q, F.lit(")")))
    post = F.when(name.rlike(rf"{WORD}\z"), F.lit(f"(?!{WORD})")).otherwise(F.lit(f"(?={WORD})"))
    return F.concat(F.lit("(?iu)"), q, pre, post)


def same_text(text, name) -> Column:
    """Whether a text is the name, letter for letter, in any case, as a case-insensitive
    pattern sees it.  Nearly all hits are equal as they stand and need no pattern."""
    whole = F.concat(F.lit(r"(?iu)\A"), quote_literal(name), F.lit(r"\z"))
    return (col(text) == col(name)) | ((F.length(col(text)) == F.length(col(name))) & F.rlike(col(text), whole))


def word_tokens(c) -> Column:
    """Array of maximal word runs of the text."""
    return F.regexp_extract_all(col(c), F.lit(f"{WORD}+"), 0)


def nullif_empty(c) -> Column:
    return F.when(col(c) == "", None).otherwise(col(c))


def wikilink(c) -> Column:
    return F.concat(F.lit("[["), col(c), F.lit("]]"))
