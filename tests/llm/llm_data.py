import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    """documents with the given texts; ids default to 0, 1, ..."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def prose(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a repeated id, a long text, non-ASCII."""
    texts = [None, "", " \n\t ", "Ein Wort", "ein wort", "x" * 50_000, prose(30_000, 1), "é😀 ñ\n\nÀ B", "ein wort", None, "last", prose(90, 2), prose(90, 2)]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, None, None, 5, 20, 20]
    sources = [None, "a", "a", "a", "b", "b", "b", "c", None, None, "b", "d", "d"]
    return documents(spark, texts, ids, sources)


@pytest.fixture(scope="session")
def clashing(spark):
    """A table whose extra columns have the names that the operators use themselves."""
    names = ["_id", "_th", "h", "bytes", "bucket", "sid", "token", "tokens", "size", "key", "kind", "a", "b", "n", "_row", "_text", "spans", "score", "target", "_source", "_cell", "label", "_hot", "n_lines", "kept_text", "_at"]

    def make(docs):
        from pyspark.sql import functions as F
        return docs.select("*", *[F.lit("clash").alias(n) for n in names])

    return make


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
