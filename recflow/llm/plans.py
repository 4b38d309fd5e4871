"""The registered queries of the corpus operators, with their SQL where SQL can express them.

Each query reads its whole table through its operator and derives the contract's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import (
    bpe,
    exact_dedup,
    html_extract,
    lexical,
    licenses,
    mixing,
    ngram_join,
    prefix_trie,
    quality,
    secrets,
    toxicity,
    vector_search,
    warc,
)
from recflow.llm.common import read


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extracted(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_tokens.*")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scanned(read(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("license_spans", lambda x: x["coverage"]))
    spans = F.array_join(F.transform("license_spans", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"])), ",")
    return out.select("doc_id", F.size("license_spans").cast("long").alias("n_notices"),
                      F.coalesce(best, F.lit(0.0)).alias("coverage"), spans.alias("spans"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(read(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["base"])

    def count(k: int, name: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind_no"] == k)).cast("long").alias(f"n_{name}")

    return out.select(
        F.col("id").alias("doc_id"),
        *(count(k, d.kind) for k, d in enumerate(secrets.BASE)),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("found")).alias("spans"),
        F.size(F.filter(base, lambda x: ~x["live"])).cast("long").alias("n_example"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    out = quality.judge(docs, quality.fit(docs, labels))
    return out.select("doc_id", *(F.col(f"_quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = toxicity.scored(docs.select("doc_id", "text"), toxicity.fit(docs, read(spark, sf_dir, "labels")))
    score = F.col("_toxic.score")
    return out.select("doc_id", toxicity.held_out().alias("held_out"), score.alias("score"),
                      (score >= 0.5).cast("int").alias("predicted"), F.col("_toxic.spans").alias("spans"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    out = warc.read_archive(*warc.write_archive(pages), id_type=dict(pages.dtypes)["page_id"])
    return out.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("rep").alias("rep_id"), "class_id", "n_links")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(read(spark, sf_dir, "conversations"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vector_search.search(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, "vec_id", "embedding")
    return out.select(F.col("query").cast("long").alias("query_id"), "rank", F.col("id").cast("long").alias("vec_id"),
                      F.col("distance").alias("score"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").cast("long").alias("doc_id"), "score")


QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_bpe": op2_bpe,
    "op3_licenses": op3_licenses,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_secrets": op5_secrets,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_ngram_join": op10_ngram_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_nearest_vectors": op12_nearest_vectors,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES = {
    "op11_prefix_trie": r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        [coalesce(role, ''), coalesce(text, '')] AS turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(turn ORDER BY pos) AS turns FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(conv_id::VARCHAR) + 1),
        lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
        4294967295) % 6 AS h FROM o),
r AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM crc c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, len(turns) AS total, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r),
n AS (SELECT turns[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        string_agg(CASE WHEN total = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends FROM p GROUP BY ALL),
v AS (SELECT *, (n_convs - 1) * length(coalesce(prefix[depth][2], '')) AS saved FROM n),
c AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN c USING (prefix, depth)),
s AS (SELECT a.prefix, a.depth, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
    FROM w a JOIN w b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY ALL)
SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens,
    sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN s USING (prefix, depth) LEFT JOIN n u ON w.depth > 0 AND u.depth = w.depth - 1 AND u.prefix = w.prefix[1:w.depth - 1]
""",
    "op13_lexical_search": r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, docs),
m AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM n, c),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
""",
    "op8_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
r AS (SELECT page_id, h, first_id, octet_length(encode(h)) AS n FROM p JOIN g USING (h))
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
""",
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
""",
}
