"""The model stage as a stream over the routed documents.

A batch takes the documents of the fallback bucket that were newly routed, after those that
earlier batches left without a verdict (over the budget, a failed call, an unreadable reply).
Tables under one root, a folder a batch:

``replies``  what the model answered, by the prompt's hash, written before any reply is
             decoded: a replayed batch finds its folder whole and asks nothing again
``known``    usable replies in segments with Bloom sketches: a prompt that comes again, in
             whatever batch, takes the old reply; only segments that may hold it are read
``verdicts`` category, flag and provenance of the documents (folders ``docs_batch=M`` within)
``open``     documents without a verdict after the batch
``calls``    one row: calls up to and including the batch
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import sync_flag
from recflow.operators import reclassify as R
from recflow.sources.ledger import Ledger, folders
from recflow.streaming import stages as S

KEY = "recording_id"
REPLY = "raw string, cache_read long, cache_create long"
OPEN_SCHEMA = "recording_id string, docs_batch long, since long"
VERDICTS_SCHEMA = ("recording_id string, category string, sync_blocked boolean, "
                   "llm struct<model:string,confidence:double,reason:string,at:string>, batch_id long, docs_batch long")


@dataclass
class ModelStage:
    """``per_batch``: most documents that a batch asks about; ``calls``: most calls of all
    batches together.  By default neither is bounded.  What a budget leaves out stays open,
    oldest first, for the next batch; nothing is dropped."""
    root: str
    docs_path: str
    model: str
    at: str
    scorer: R.Scorer | None = None
    factory: Callable[[], R.Scorer] | None = None
    per_batch: int | None = None
    calls: int | None = None

    def known(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, f"{self.root}/known", key="prompt_hash", more=REPLY)

    def allowance(self, spark: SparkSession, batch_id: int) -> tuple[int, int | None]:
        """Calls of the batches before, and the documents that this one may ask about."""
        made = S._last_before(spark, f"{self.root}/calls", batch_id, "calls long").first()
        made = made["calls"] if made else 0
        left = None if self.calls is None else max(0, self.calls - made)
        return made, min((x for x in (left, self.per_batch) if x is not None), default=None)


def _prompts(spark: SparkSession, picked: DataFrame, stage: ModelStage, batch_id: int) -> DataFrame:
    """The documents with their prompts, written once; of the texts only the folders of the
    batches that pulled these documents are read."""
    held = S.of_batches(spark, stage.docs_path, S.DOCS_SCHEMA, picked.select("docs_batch"))
    texts = held.select(KEY, F.col("batch_id").alias("docs_batch"), F.coalesce("name", F.lit("")).alias("title"), "summary")
    path = f"{stage.root}/prompts/batch_id={batch_id}"
    (R.with_prompt(picked.join(texts, [KEY, "docs_batch"]))
     .select(KEY, "docs_batch", F.sha2("prompt", 256).alias("prompt_hash"), "prompt")
     .write.mode("overwrite").parquet(path))
    return spark.read.schema(f"{KEY} string, docs_batch long, prompt_hash string, prompt string").parquet(path)


def reclass_batch(batch: DataFrame, batch_id: int, stage: ModelStage) -> None:
    spark, root = batch.sparkSession, stage.root
    made, allowed = stage.allowance(spark, batch_id)
    fresh = batch.where(F.col("category") == vocab.FALLBACK_CATEGORY).select(KEY, "docs_batch", F.lit(batch_id).cast("long").alias("since"))
    wanted = S._last_before(spark, f"{root}/open", batch_id, OPEN_SCHEMA).unionByName(fresh)
    picked = wanted if allowed is None else wanted.orderBy("since", KEY).limit(allowed)
    prompts = _prompts(spark, picked, stage, batch_id)

    known = stage.known(spark)
    known.compact(before=batch_id)
    hashes = prompts.select("prompt_hash")
    old = known.candidates(hashes, before=batch_id).dropDuplicates(["prompt_hash"]).join(hashes.distinct(), "prompt_hash", "left_semi")
    if not folders(spark, f"{root}/replies").get(f"batch_id={batch_id}"):
        new = (prompts.groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"))
               .join(old.select("prompt_hash"), "prompt_hash", "left_anti"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # calls don't run in one task
        (R.classify_model(new.repartition(tasks, "prompt_hash"), stage.scorer, "prompt_hash", stage.factory)
         .write.mode("overwrite").parquet(f"{root}/replies/batch_id={batch_id}"))
    replies = spark.read.schema(f"prompt_hash string, {REPLY}, error string").parquet(f"{root}/replies/batch_id={batch_id}")
    spark.range(1).select((F.lit(made) + replies.agg(F.count(F.lit(1))).scalar()).alias("calls")).write.mode("overwrite").parquet(
        f"{root}/calls/batch_id={batch_id}")

    def usable(rows: DataFrame) -> DataFrame:
        return R.verdicts_ok(R.verdict_decode(rows))

    known.append(usable(replies), batch_id)
    verdicts = usable(replies.unionByName(old.withColumn("error", F.lit(None).cast("string"))))
    documents = prompts.select(KEY, "docs_batch", "prompt_hash", F.lit(vocab.FALLBACK_CATEGORY).alias("category"))
    documents = documents.withColumn("sync_blocked", sync_flag("category"))
    patched = R.patch_reclassified(R.verdict_join(documents, verdicts, "prompt_hash"), stage.model, stage.at)
    path = f"{root}/verdicts/batch_id={batch_id}"
    (patched.where(F.col("llm").isNotNull()).select(KEY, "category", "sync_blocked", "llm", "docs_batch")
     .write.mode("overwrite").partitionBy("docs_batch").parquet(path))
    done = S.read_or_empty(spark, path, f"{KEY} string, docs_batch long")
    wanted.join(done, [KEY, "docs_batch"], "left_anti").write.mode("overwrite").parquet(f"{root}/open/batch_id={batch_id}")


def start_reclass(spark: SparkSession, routed_path: str, stage: ModelStage, checkpoint: str):
    """The model stage as a stream over the routed table's fallback bucket."""
    return S._over(spark, routed_path, S.ROUTED_SCHEMA, checkpoint, lambda df, bid: reclass_batch(df, bid, stage),
                   only=F.col("category") == vocab.FALLBACK_CATEGORY)


def verdicts_on(spark: SparkSession, root: str, documents: DataFrame) -> DataFrame:
    """The verdicts on documents(recording_id, docs_batch): only folders of their batches are read."""
    numbers = [r[0] for r in documents.select("docs_batch").distinct().collect()]  # numbers of batches
    return (S.read_or_empty(spark, f"{root}/verdicts", VERDICTS_SCHEMA).where(F.col("docs_batch").isin(numbers))
            .join(documents.select(KEY, "docs_batch").distinct(), [KEY, "docs_batch"], "left_semi"))
