"""Keyword routing: ordered first-match rules folded into one CASE WHEN.

One projection, no shuffle; the only shuffle is the (map-side combined)
per-category count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import sync_flag
from recflow.functions.text import col, words_pattern


def category_expr(title, rules=vocab.ROUTING_RULES, fallback=vocab.FALLBACK_CATEGORY) -> Column:
    """First rule whose whole-word keywords occur in the title, else the fallback."""
    t = F.coalesce(col(title), F.lit(""))
    expr = None
    for category, _blocked, words in rules:
        cond = t.rlike(words_pattern(words))
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(fallback)) if expr is not None else F.lit(fallback)


def blocked_expr(category, rules=vocab.ROUTING_RULES) -> Column:
    blocked = [c for c, b, _ in rules if b]
    return F.coalesce(col(category).isin(blocked), F.lit(vocab.FALLBACK_BLOCKED))


def classify_title(df: DataFrame, title: str = "title", rules=vocab.ROUTING_RULES) -> DataFrame:
    """Adds ``category`` and ``sync_blocked``."""
    out = df.withColumn("category", category_expr(title, rules))
    return out.withColumn("sync_blocked", blocked_expr("category", rules))


def rule_hits(df: DataFrame, title: str = "title", rules=vocab.ROUTING_RULES) -> DataFrame:
    """Tuning view: for every rule keyword, how many titles contain it.

    One regex per rule decides whether any keyword of it occurs; only then its keywords
    are tested one by one, and only hits are exploded.
    """
    t = F.coalesce(col(title), F.lit(""))
    hits = []
    for category, _blocked, words in rules:
        each = F.array(*(F.when(t.rlike(words_pattern([w])), F.struct(F.lit(category).alias("category"), F.lit(w).alias("keyword")))
                         for w in words))
        none = F.array().cast("array<struct<category:string,keyword:string>>")
        hits.append(F.when(t.rlike(words_pattern(words)), F.array_compact(each)).otherwise(none))
    exploded = df.select(F.explode(F.concat(*hits)).alias("h"))
    return (exploded.groupBy(F.col("h.category").alias("category"), F.col("h.keyword").alias("keyword"))
            .agg(F.count(F.lit(1)).alias("n_titles")))


def route_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n_docs"))


def patch_routed(df: DataFrame, routed_at: str) -> DataFrame:
    """Header update after routing; documents without a header are untouched.

    The status line is rewritten only where it exists; category, sync flag and
    routing time are added.
    """
    has = F.col("has_header")
    return df.withColumns({
        "status": F.when(has & F.col("status").isNotNull(), F.lit(vocab.STATUS_ROUTED))
                   .otherwise(F.col("status")),
        "routed_category": F.when(has, F.col("category")),
        "routed_sync_blocked": F.when(has, sync_flag("category")),
        "routed_at": F.when(has, F.lit(routed_at)),
    })


def sibling_bundle(docs: DataFrame, files: DataFrame, stem: str = "stem",
                   file_name: str = "file_name", directory: str = "directory") -> DataFrame:
    """Files of a document's directory whose name starts with its stem travel with it;
    a file that several stems begin goes with the first document in path order.

    A prefix join without a nested loop: every file name is expanded to its
    prefixes of the lengths stems actually have (a set bounded by the longest
    file name, so it is broadcast), then equi-joined on directory and prefix.
    """
    lengths = docs.select(F.length(stem).alias("_len")).distinct()
    pre = (files.select(directory, file_name, F.explode(F.sequence(F.lit(1), F.length(file_name))).alias("_len"))
           .join(F.broadcast(lengths), "_len"))
    keyed = pre.select(directory, file_name, F.left(F.col(file_name), F.col("_len")).alias(stem))
    found = keyed.join(docs.select(directory, stem).distinct(), [directory, stem])
    first = F.min(F.concat(F.col(stem), F.lit(".md"))).alias("_doc")
    return (found.groupBy(directory, file_name).agg(first)
            .select(directory, F.expr("left(_doc, length(_doc) - 3)").alias(stem), file_name))
