import random

import pytest

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHES = ("id", "text_sha256", "key", "row", "norm", "size", "kept", "rep", "cls", "target", "found", "_stats", "_quality", "gone")


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa la mu nu xi omicron".split()) +
                    str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    long = words(rng, 6000)
    near = words(rng, 120)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one two", "en", None, 7),
            (5, long, "en", "b", 1), (6, long + " tail", "en", "b", 1), (7, near, "en", "c", 1), (8, near + " x", "en", "c", 1),
            (9, near.replace(" ", "\n"), "en", "c", 1), (10, near, "en", "c", 1), (10, near, "en", "c", 1), (11, "ü" * 60, "de", "d", 1),
            (None, near, "en", "c", 1), (12, words(rng, 200), "en", "a", 1), (13, words(rng, 300), "fr", "b", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
