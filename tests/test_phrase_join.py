"""The positional phrase join of names: parity with Python's re, and its cost."""
import random
import re
import time

from recflow.operators import entities as EN


def mentions(spark, texts, names):
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_key string, text string")
    ents = spark.createDataFrame([(n, "People", 1) for n in names], "name string, type string, type_rank int")
    return {(int(r["doc_key"]), r["name"]) for r in EN.entity_mentions(docs, ents).collect()}


def test_phrases_equal_python_re(spark):
    """Names of one to five words with shared words, odd separators, repeated words."""
    rng = random.Random(3)
    word = ["an", "An", "bee", "BEE", "cé", "CÉ", "ſo", "So", "d_1", "E"]
    sep = [" ", " ", " ", "  ", "-", ", ", " & ", "\n", "#"]

    def phrase(n):
        return "".join(rng.choice(word) + rng.choice(sep) for _ in range(n - 1)) + rng.choice(word)

    names = list({phrase(rng.randrange(1, 6)) for _ in range(60)} | {"an an", "an an an", "(an)", "#an", "an#", "&", " & ", "bee.", "so "})
    texts = [rng.choice(["", "(", " ", "#"]) + phrase(rng.randrange(1, 60)) + rng.choice(["", ")", ".", "#x"]) for _ in range(400)]
    want = {(i, n) for i, t in enumerate(texts) for n in names if re.search(r"\b" + re.escape(n) + r"\b", t, re.I)}
    assert mentions(spark, texts, names) == want and len(want) > 500


def test_cost_does_not_follow_the_longest_name(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=1500)) for _ in range(300)]
    names = ["w1 w2", "w3 w4 w5", "w17", "w399 w0"]
    long = " ".join(rng.choices(vocabulary, k=150))

    def timed(ns):
        t0 = time.perf_counter()
        found = mentions(spark, texts, ns)
        return time.perf_counter() - t0, found

    timed(names)
    (short_s, short), (long_s, with_long) = min(timed(names), timed(names)), min(timed([*names, long]), timed([*names, long]))
    assert short == with_long and {n for _, n in short} >= {"w1 w2", "w17"}
    assert long_s < 1.2 * short_s + 1.0  # a second for noise of a busy machine


def test_index_holds_only_words_of_the_dictionary(spark):
    docs = spark.createDataFrame([("d", "one two three, one four")], "doc_key string, text string")
    ents = spark.createDataFrame([("One Four", "People", 1)], "name string, type string, type_rank int")
    words = EN.name_words(ents)
    got = [(r["_part"], r["_no"]) for r in EN.word_index(docs, words).orderBy("_no").collect()]
    assert got == [("one", 0), ("one", 3), ("four", 4)]
    assert words.where("_anchor").count() == 1
