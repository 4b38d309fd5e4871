"""Model reclassification of the fallback bucket.

The model call is the only Python in the pipeline: a user-supplied scorer
runs in ``mapInPandas`` (one client per partition, Arrow batches); a budget of
calls per run is optional.  Decoding the reply is pure SQL: a strict JSON gate,
variant accessors, and two substring fallbacks.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import fence_strip, prompt_text, reason_clean, summary_excerpt, sync_flag
from recflow.functions.text import col, py_strip

Scorer = Callable[[pd.Series], pd.DataFrame]


def reclass_batch(docs: DataFrame, max_docs: int | None = None, key: str = "doc_key") -> DataFrame:
    """Fallback-bucket documents; with ``max_docs`` (a budget of model calls) the first
    so many in key order, dealt out again so that the calls don't run in one task."""
    d = docs.where(F.col("category") == vocab.FALLBACK_CATEGORY)
    if max_docs is None:
        return d
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return d.orderBy(key).limit(max_docs).repartition(tasks, key)


def with_prompt(df: DataFrame, title: str = "title", summary: str = "summary",
                excerpt_chars: int | None = None) -> DataFrame:
    return df.withColumn("prompt", prompt_text(title, summary_excerpt(summary, excerpt_chars)))


def classify_model(df: DataFrame, scorer: Scorer | None, key: str = "doc_key",
                   factory: Callable[[], Scorer] | None = None) -> DataFrame:
    """Run ``scorer`` over the prompts: (key, prompt) -> (key, raw, cache_read, cache_create, error).

    ``scorer`` receives a pandas Series of prompts and returns a DataFrame with
    columns raw, cache_read, cache_create; ``factory`` makes one scorer (and its
    client) per partition instead.  A batch that raises is tried again row by row:
    a document whose call fails has a NULL reply and the message in ``error``, the
    others keep theirs.  With neither (no credentials) there are no verdicts.
    """
    schema = f"{key} string, raw string, cache_read long, cache_create long, error string"
    if scorer is None and factory is None:
        return df.sparkSession.createDataFrame([], schema)

    def one(score: Scorer, prompts: pd.Series) -> pd.DataFrame:
        out = score(prompts).reset_index(drop=True)
        return pd.DataFrame({"raw": out["raw"], "cache_read": out["cache_read"].astype("int64"),
                             "cache_create": out["cache_create"].astype("int64"), "error": None})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = factory() if factory is not None else scorer
        for pdf in batches:
            try:
                out = one(score, pdf["prompt"])
            except Exception:  # noqa: BLE001  whatever a caller's scorer raises
                rows = []
                for prompt in pdf["prompt"]:
                    try:
                        rows.append(one(score, pd.Series([prompt])))
                    except Exception as e:  # noqa: BLE001
                        rows.append(pd.DataFrame({"raw": [None], "cache_read": [0], "cache_create": [0],
                                                  "error": [f"{type(e).__name__}: {e}"]}))
                out = pd.concat(rows, ignore_index=True)
            out.insert(0, key, pdf[key].reset_index(drop=True))
            yield out

    return df.select(key, "prompt").mapInPandas(run, schema)


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


#: FIXED VALUES: text that the original reads as a number (digits may be grouped by '_').
FLOAT_TEXT = (r"^[+-]?(([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?"
              r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$")


def float_text(value: Column) -> Column:
    """Number of a text, NULL if it is none; Java's own suffixes and hexadecimal forms are none."""
    stripped = py_strip(value)
    return F.when(stripped.rlike(FLOAT_TEXT), F.replace(stripped, F.lit("_"), F.lit("")).try_cast("double"))


def verdict_decode(replies: DataFrame, raw: str = "raw", echo_chars: int | None = None,
                   reason_chars: int | None = None) -> DataFrame:
    """Adds category, confidence, reason, valid_category, error (NULL when ok).

    ``echo_chars`` / ``reason_chars`` cut the quoted reply and the reason; by default
    nothing is cut (vocab has the original's limits).

    Tier 1: the (fence-stripped) reply is exactly one JSON value; it must be
    an object with a string ``category``; ``confidence`` (default 0) must be
    numeric, boolean or numeric text.  Tier 2: not JSON but names a category
    (first in list order) -> 0.5.  Tier 3: otherwise Business, 0.0 and an
    "unparseable" reason quoting the reply.
    """
    text = fence_strip(raw)
    # Parsers stop at the bracket that closes the wrapper, so text after the value
    # can hide behind a stray one; what closes the list can't close the object too.
    in_list, in_object = F.concat(F.lit("["), text, F.lit("]")), F.concat(F.lit('{"v":'), text, F.lit("}"))
    fields = "STRUCT<category: VARIANT, confidence: VARIANT, reason: VARIANT>"
    strict_json = {"allowSingleQuotes": "false"}
    # repeated keys (the last counts) and NaN are accepted here, as the original's parser does
    obj = F.from_json(in_object, f"v {fields}", strict_json)["v"]
    is_obj = obj.isNotNull() & F.coalesce(F.size(F.from_json(in_list, f"ARRAY<{fields}>", strict_json)) == 1, F.lit(False))
    other = F.try_parse_json(in_object).isNotNull() & F.coalesce(F.array_size(
        F.try_variant_get(F.try_parse_json(in_list), "$", "array<variant>")) == 1, F.lit(False))
    strict = (text != "") & (is_obj | other)
    cat_v, conf_v, reason_v = (F.when(is_obj, obj[k]) for k in ("category", "confidence", "reason"))
    cat_t, conf_t, reason_t = _vtype(cat_v), _vtype(conf_v), _vtype(reason_v)

    conf_num = (F.when(conf_v.isNull(), F.lit(0.0))
                .when(conf_t == "BOOLEAN", F.try_variant_get(conf_v, "$", "boolean").cast("double"))
                .when(conf_t == "STRING", float_text(F.try_variant_get(conf_v, "$", "string")))
                .when(conf_t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"),
                      F.try_variant_get(conf_v, "$", "double")))
    reason_txt = (F.when(reason_v.isNull(), F.lit(""))
                  .when(reason_t == "STRING", F.try_variant_get(reason_v, "$", "string"))
                  .when(reason_t == "VOID", F.lit("None"))
                  .when(reason_t == "BOOLEAN", F.when(F.try_variant_get(reason_v, "$", "boolean"),
                                                      F.lit("True")).otherwise(F.lit("False")))
                  .otherwise(F.to_json(reason_v)))
    error = (F.when(~is_obj, F.lit("not an object"))
             .when(cat_v.isNull(), F.lit("no category"))
             .when(cat_t != "STRING", F.lit("category not text"))
             .when(conf_num.isNull(), F.lit("confidence not numeric")))

    fallback_cat = None
    for c in vocab.VALID_CATEGORIES:
        cond = text.contains(c)
        fallback_cat = F.when(cond, F.lit(c)) if fallback_cat is None else fallback_cat.when(cond, F.lit(c))
    named = fallback_cat.otherwise(F.lit(None))

    category = (F.when(strict, F.when(error.isNull(), F.try_variant_get(cat_v, "$", "string")))
                .when(named.isNotNull(), named)
                .otherwise(F.lit(vocab.UNPARSEABLE_CATEGORY)))
    confidence = (F.when(strict, F.when(error.isNull(), conf_num))
                  .when(named.isNotNull(), F.lit(vocab.PARSE_FALLBACK_CONFIDENCE))
                  .otherwise(F.lit(0.0)))
    reason = (F.when(strict, F.when(error.isNull(), reason_txt))
              .when(named.isNotNull(), F.lit(vocab.PARSE_FALLBACK_REASON))
              .otherwise(F.concat(F.lit(vocab.UNPARSEABLE_PREFIX),
                                  text if echo_chars is None else F.substring(text, 1, echo_chars))))
    called = F.col("error") if "error" in replies.columns else F.lit(None).cast("string")
    out = replies.withColumns({
        "clean": text,
        # a call that failed has no reply to decode
        "error": F.when(called.isNotNull(), called).when(strict, error),
        "tier": F.when(strict, F.lit(1)).when(named.isNotNull(), F.lit(2)).otherwise(F.lit(3)),
    })
    return out.withColumns({
        "category": category, "confidence": confidence,
        "reason": reason if reason_chars is None else F.substring(reason, 1, reason_chars),
        "valid_category": category.isin(vocab.VALID_CATEGORIES),
    })


def verdict_errors(decoded: DataFrame, key: str = "doc_key") -> DataFrame:
    """Replies that fail decoding: the document keeps its place, logged as failed."""
    return decoded.where(F.col("error").isNotNull()).select(key, "error")


def verdicts_ok(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error").isNull())


def verdict_join(docs: DataFrame, decoded: DataFrame, key: str = "doc_key") -> DataFrame:
    """Documents with their verdict (left join); the verdict category wins."""
    v = verdicts_ok(decoded).select(key, F.col("category").alias("_vcat"),
                                    F.col("confidence").alias("_vconf"), F.col("reason").alias("_vreason"))
    return (docs.join(v, key, "left")
            .withColumn("category_after", F.coalesce("_vcat", "category")))


def patch_reclassified(joined: DataFrame, model: str, at: str, reason_chars: int | None = None) -> DataFrame:
    """Header update for reclassified documents: category and flag overwritten,
    provenance added (double quotes of the reason made single)."""
    has = F.col("_vcat").isNotNull()
    return joined.withColumns({
        "category": F.col("category_after"),
        "sync_blocked": F.when(has, sync_flag("category_after")).otherwise(F.col("sync_blocked")),
        "llm": F.when(has, F.struct(F.lit(model).alias("model"), F.col("_vconf").alias("confidence"),
                                    reason_clean("_vreason", reason_chars).alias("reason"), F.lit(at).alias("at"))),
    }).drop("_vcat", "_vconf", "_vreason", "category_after")


def reclass_counts(decoded: DataFrame) -> DataFrame:
    """Verdicts per category with the prompt-cache token counters."""
    return (verdicts_ok(decoded).groupBy("category")
            .agg(F.count(F.lit(1)).alias("n_verdicts"),
                 F.sum("cache_read").cast("bigint").alias("cache_read"),
                 F.sum("cache_create").cast("bigint").alias("cache_create")))


def keyword_scorer(prompts: pd.Series) -> pd.DataFrame:
    """A deterministic stand-in scorer (no network): picks a category from
    words in the prompt and answers in the model's JSON format."""
    lower = prompts.str.lower()
    cat = pd.Series("Business", index=prompts.index)
    cat[lower.str.contains("lecture|course|class", regex=True)] = "Learning"
    cat[lower.str.contains("family|friend", regex=True)] = "Casual"
    cat[lower.str.contains("clinic|health", regex=True)] = "Personal-Health"
    raw = '{"category": "' + cat + '", "confidence": 0.6, "reason": "keywords in the prompt"}'
    return pd.DataFrame({"raw": raw, "cache_read": prompts.str.len() % 7, "cache_create": 0})


# the scorer is sent to the workers by value: they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
