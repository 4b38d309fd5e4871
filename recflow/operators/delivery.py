"""Delivery-candidate detection: Business documents with a company mention
and delivery language in the summary + transcript head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.text import col, words_pattern

DELIVERY_PATTERN = words_pattern(vocab.DELIVERY_SIGNALS)


def delivery_signal(text) -> Column:
    return F.coalesce(col(text).rlike(DELIVERY_PATTERN), F.lit(False))


def delivery_candidates(docs: DataFrame, company_lists: DataFrame, key: str = "doc_key") -> DataFrame:
    """docs(key, category, delivery_text, ...) x company_lists(key, companies).

    Inner join = "at least one company mention"; the signal and category are
    plain filters pushed below the join.
    """
    d = docs.where((F.col("category") == "Business") & delivery_signal("delivery_text"))
    return d.join(company_lists, key)
