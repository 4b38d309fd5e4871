"""Speaker-attributed transcript text from a turn table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transcript_text(turns: DataFrame, key: str, turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """One text per ``key``: ``role: text`` lines ordered by turn, newline-joined.

    Partial aggregation is not possible for an ordered concatenation, so the
    turns of one recording meet in one task; that group is one transcript.
    """
    line = F.struct(F.col(turn).alias("turn"), F.concat(F.col(role), F.lit(": "), F.col(text)).alias("line"))
    return (turns.groupBy(key)
            .agg(F.array_sort(F.collect_list(line)).alias("_lines"))
            .select(key, F.array_join(F.transform("_lines", lambda x: x["line"]), "\n").alias("transcript")))
