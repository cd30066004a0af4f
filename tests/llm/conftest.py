import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def words(rng, n):
    return [rng.choice("abcdefghijklmnop") + str(rng.randrange(4000)) for _ in range(n)]


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text, copies."""
    rng = random.Random(3)
    long = " ".join(words(rng, 40_000))
    base = " ".join(words(rng, 120))
    near = base.split()
    near[50] = "changed"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "", "en", "a", 0), (3, "", "en", "a", 0),
            (4, base, "en", "a", 1), (5, base, "de", "b", 1), (5, base, "de", "b", 1), (6, base.upper(), "en", None, 1),
            (7, " ".join(near), "en", "b", 1), (8, long, "en", "c", 1), (None, "no id here", "en", "c", 1),
            (None, None, None, None, None), (9, "   \n\t ", "fr", "a", 4), (10, "É è ß 漢字 😀 é", "fr", "c", 3),
            (11, "one two", "en", "b", 2), (12, "x" * 5000, "en", "b", 3), (13, "12345 67 !!", "en", "c", 3),
            (14, ". . . . " * 300, "en", "c", 3), (15, "a b c\rd", "en", "a", 3)]
    rows += [(20 + k, " ".join(words(rng, 5 + 7 * k)), "en", "abc"[k % 3], k) for k in range(30)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def wide(docs):
    """The same rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    extra = ["th", "rid", "key", "a", "b", "units", "recipe", "hash", "kept", "x_doc", "x_hash", "x_n", "m_doc", "m_hash", "m_n",
             "block", "size", "norm", "chunks", "p", "spans", "rank", "label", "embedding", "bin"]
    return docs.withColumns({c: F.lit("other") for c in extra})
