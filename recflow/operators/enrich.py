"""Enrichment (L3) of routed documents: mentions, action items, delivery
candidates, idempotent sink rows, header patches and batch counts.

Every branch hangs off two tables made from the texts in one pass, mentions and facts;
every sink is "candidates left_anti existing".
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import (bracket_list, delivery_text, recorded_date,
                                           search_text, title_fallback)
from recflow.operators.actions import action_items
from recflow.operators.delivery import delivery_signal
from recflow.operators.entities import company_hits, entity_mentions, mention_list
from recflow.operators.sinks import append_new, backlink_line, candidate_line, rollup_block
from recflow.operators.sketch import sketched
from recflow.session import TEXTS, stored


def enrich_pending(df: DataFrame, reenrich_on_category_change: bool = False) -> DataFrame:
    """Anything but an 'enriched' status (a missing status included) is pending.

    By default an enriched document is never looked at again, even if it was
    reclassified afterwards (so a document enriched while unclassified never
    gets action items).  With ``reenrich_on_category_change`` a document whose
    category differs from the one recorded at enrichment (``enriched_category``)
    is pending again."""
    pending = F.col("status").isNull() | (F.col("status") != vocab.STATUS_ENRICHED)
    if reenrich_on_category_change and "enriched_category" in df.columns:
        pending = pending | ~F.col("category").eqNullSafe(F.col("enriched_category"))
    return df.where(pending)


def action_category_gate(df: DataFrame) -> DataFrame:
    return df.where(F.col("category").isin(vocab.ACTION_CATEGORIES))


def sidecars_joined(docs: DataFrame, summaries: DataFrame, transcripts: DataFrame,
                    key: str = "doc_key") -> DataFrame:
    """Attach summary and transcript sidecars by their key; missing -> ''."""
    return (docs.join(summaries.select(key, "summary"), key, "left")
            .join(transcripts.select(key, "transcript"), key, "left")
            .withColumns({"summary": F.coalesce("summary", F.lit("")),
                          "transcript": F.coalesce("transcript", F.lit(""))}))


def prepare(docs: DataFrame, run_date: str, key: str = "doc_key") -> DataFrame:
    """Per-document derived texts and dates used by all three branches."""
    return docs.withColumns({
        "title_eff": title_fallback("title", key),
        "recorded_date": recorded_date("recorded_at", "uploaded_at", run_date),
        "search_text": search_text("summary", "transcript"),
        "delivery_text": delivery_text("summary", "transcript"),
    })


class EnrichBatch:
    """One enrichment run.  The texts are joined once: what is written to the shared folder
    when first needed is ``facts`` (a row per pending document with its dates, action items and
    delivery signal) and beside them, where names are looked for, the texts to search.
    ``mentions``, lists, links, candidates, blocks, patches and counts derive from this table."""

    def __init__(self, docs: DataFrame, summaries: DataFrame, transcripts: DataFrame, entities: DataFrame,
                 run_date: str, enriched_at: str, existing_backlinks: DataFrame | None = None,
                 existing_blocks: DataFrame | None = None, existing_candidates: DataFrame | None = None,
                 key: str = "doc_key", reenrich_on_category_change: bool = False,
                 categories: list[str] | None = None, stem: str | None = None, sidecar_key: str | None = None):
        """docs(key, title, category, status, recorded_at, uploaded_at, has_header);
        ``categories``: the buckets that are enriched (default: all given); ``stem``: the
        column that links name a document by (default: the key); ``sidecar_key``: the column
        that the texts are attached by (default: the key).  Texts that lie distributed by
        that column don't move for the join."""
        if categories is not None:
            docs = docs.where(F.col("category").isin(categories))
        if "has_header" not in docs.columns:
            docs = docs.withColumn("has_header", F.lit(True))
        pending = enrich_pending(docs, reenrich_on_category_change)
        self.docs, self.key, self.entities, self.enriched_at = docs, key, entities, enriched_at
        self.existing = existing_backlinks, existing_blocks, existing_candidates
        self.stem = stem or key
        self.prepared = prepare(sidecars_joined(pending, summaries, transcripts, sidecar_key or key), run_date, self.stem)

    def _read(self, *texts: str) -> DataFrame:
        """The pass over the texts: the facts, and the texts that are asked for."""
        gated = F.col("category").isin(vocab.ACTION_CATEGORIES)
        found = F.when(gated, action_items("summary"))
        business = F.col("category") == "Business"
        return self.prepared.select(
            *dict.fromkeys((self.key, self.stem)), "has_header", "status", "category", "recorded_date", "title_eff",
            F.when(F.size(found) > 0, found).alias("items"),
            F.when(business, delivery_signal("delivery_text")).otherwise(F.lit(False)).alias("signal"), *texts)

    @cached_property
    def searched(self) -> DataFrame:
        return stored(self._read("search_text"), "enrich-texts", **TEXTS)

    @cached_property
    def facts(self) -> DataFrame:
        """What looks for names does that first, so that the facts lie beside the texts."""
        if "searched" in self.__dict__:
            return self.searched.drop("search_text")
        return stored(self._read(), "enrich-facts")

    @cached_property
    def mentions(self) -> DataFrame:
        texts = self.searched.select(self.key, F.col("search_text").alias("text"))
        return stored(entity_mentions(texts, self.entities, key=self.key), "enrich-mentions")

    @cached_property
    def company_mentions(self) -> DataFrame:
        """Companies of the documents with a delivery signal: where nothing else has asked for
        all mentions, only these documents and names are matched."""
        if "mentions" in self.__dict__:
            return company_hits(self.mentions)
        texts = self.searched.select(self.key, F.col("search_text").alias("text"))
        wanted = self.facts.where("signal").select(self.key).distinct()
        texts = sketched(texts, wanted, self.key, wanted.count()).join(wanted, self.key)
        return stored(entity_mentions(texts, company_hits(self.entities), key=self.key), "enrich-companies")

    @cached_property
    def names(self) -> DataFrame:
        return mention_list(self.mentions, self.key, "entity_names")

    @cached_property
    def items(self) -> DataFrame:
        return self.facts.where(F.col("items").isNotNull()).select(*dict.fromkeys((self.key, self.stem)), "recorded_date", "items")

    @cached_property
    def new_blocks(self) -> DataFrame:
        blocks = self.items.select("recorded_date", self.key, rollup_block(self.stem, "items").alias("block"))
        return append_new(blocks, self.existing[1], ["recorded_date", self.key], prune_on="recorded_date")

    @cached_property
    def candidates(self) -> DataFrame:
        companies = mention_list(self.company_mentions, self.key, "companies")
        return (self.facts.where("signal").join(companies, self.key)
                .select(self.key, "recorded_date", "title_eff", "companies",
                        candidate_line("recorded_date", self.stem, "companies", "title_eff").alias("line")))

    # sink keys lead with recorded_date (the lines embed it, so the key is the
    # same): against sinks partitioned by day, dynamic partition pruning reads
    # only the days of this batch instead of the whole history
    @cached_property
    def new_candidates(self) -> DataFrame:
        return append_new(self.candidates, self.existing[2], ["recorded_date", "line"], prune_on="recorded_date")

    @cached_property
    def new_backlinks(self) -> DataFrame:
        mentions = self.mentions
        backlinks = mentions.join(self.facts.select(*dict.fromkeys((self.key, self.stem)), "recorded_date", "title_eff"), self.key).select(
            F.col("name").alias("entity"), self.key, "recorded_date",
            backlink_line("recorded_date", self.stem, "title_eff").alias("line"))
        return append_new(backlinks, self.existing[0], ["recorded_date", "entity", "line"], prune_on="recorded_date")

    @cached_property
    def patches(self) -> DataFrame:
        names = self.names
        found = (self.facts.join(names, self.key, "left")
                 .join(self.new_candidates.select(self.key, F.lit(True).alias("vdc_added")), self.key, "left"))
        has, rolled = F.col("has_header"), F.col("items").isNotNull()
        return found.select(
            self.key,
            F.when(has & F.col("status").isNotNull(), F.lit(vocab.STATUS_ENRICHED))
             .otherwise(F.col("status")).alias("status"),
            F.when(has, F.lit(self.enriched_at)).alias("enriched_at"),
            F.when(has, bracket_list("entity_names")).alias("entity_mentions"),
            F.when(has & rolled, F.concat(F.lit('"[['), F.col("recorded_date"), F.lit(']]"'))).alias("action_items_rollup"),
            F.when(has & F.col("vdc_added").isNotNull(), F.lit(True)).alias("vdc_candidate"),
            F.when(has, F.col("category")).alias("enriched_category"))

    @cached_property
    def counts(self) -> DataFrame:
        hits = self.mentions.agg(F.count(F.lit(1))).scalar()
        done = self.facts.agg(F.count(F.lit(1)).alias("enriched"), F.count("items").alias("action_rollups"))
        return done.select(
            "enriched",
            (self.docs.agg(F.count(F.lit(1))).scalar() - F.col("enriched")).alias("skipped"),
            hits.alias("entity_hits"),
            "action_rollups",
            self.new_candidates.agg(F.count(F.lit(1))).scalar().alias("vdc_candidates"))


def enrich_batch(docs: DataFrame, summaries: DataFrame, transcripts: DataFrame, entities: DataFrame,
                 run_date: str, enriched_at: str, **options) -> EnrichBatch:
    return EnrichBatch(docs, summaries, transcripts, entities, run_date, enriched_at, **options)
