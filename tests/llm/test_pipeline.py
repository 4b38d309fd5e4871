"""The pipeline: every stage on its own input, against brute force."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from recflow.llm.common import read, stored

from .conftest import SF
from .test_dedup_join import brute, norm
from .test_quality_mix import brute_stats


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = read(spark, SF, "documents"), {}
    for name, stage in C.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF), name)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_call_the_dealt_operators():
    assert [name for name, _ in C.STAGES] == ["quality_rules", "exact_dedup", "ngram_join", "mixing", "bpe"]


def test_quality_keeps_clean_documents(spark, outputs):
    docs = rows(read(spark, SF, "documents"))
    kept = {i for i, _ in rows(outputs["quality_rules"])}
    good = {r.doc_id for r in read(spark, SF, "labels").where("quality = 1").collect()}
    junk = {r.doc_id for r in read(spark, SF, "labels").where("quality = 0").collect()}
    failed = {i for i, t in docs if brute_stats(t)[0] < 50 or 100 * brute_stats(t)[4] > 50 * brute_stats(t)[0]}
    assert not kept & failed
    assert len(good - failed - kept) <= 0.02 * len(good) and len(junk & kept) <= 0.1 * len(junk)


def test_one_of_each_text_then_of_each_group_stays(outputs):
    before = rows(outputs["quality_rules"])
    first = {}
    for i, t in sorted(before):
        first.setdefault(norm(t), i)
    exact = rows(outputs["exact_dedup"])
    assert {i for i, _ in exact} == set(first.values()) and len(exact) == len(first)
    _, group = brute(exact)
    assert sorted(i for i, _ in rows(outputs["ngram_join"])) == sorted(i for i in group if group[i] == i)


def test_the_mix_takes_documents_once_or_twice(outputs):
    before = dict(rows(outputs["ngram_join"]))
    after = rows(outputs["mixing"])
    times = {}
    for i, t in after:
        assert before[i] == t
        times[i] = times.get(i, 0) + 1
    assert max(times.values()) <= 2
    words = lambda pairs: sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t in pairs)
    assert words(after) == pytest.approx(1.5 * words(before.items()), rel=0.05)


def test_tokens_of_what_is_left(spark, outputs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = dict(rows(outputs["mixing"]))
    got = outputs["bpe"].collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows(outputs["mixing"]))
    for r in got:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(ids)


def test_stages_take_odd_rows_and_empty_tables(spark, odd, none):
    for name, stage in C.STAGES:
        out = stage(spark, odd, SF)
        assert name == "bpe" or out.columns == odd.columns
        out.collect()
        assert stage(spark, none, SF).collect() == []


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    key, before, seen = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"), []
    def first(spark, docs, sf_dir):
        seen.append(spark.conf.get(key))
        return docs.select("doc_id")
    monkeypatch.setattr(C, "STAGES", [("first", first)])
    assert C.run(spark, SF).count() == read(spark, SF, "documents").count()
    assert seen == ["8m"] and spark.conf.get(key) == before
