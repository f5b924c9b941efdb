import random

import pytest

DOCS_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns of clashing names."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs", "en", "a", 52),
        (1, "the quick brown fox jumps over the lazy dog and runs", "en", "a", 52),
        (2, "The Quick brown fox\tjumps over the\nlazy dog and runs", "en", None, None),
        (3, "", "en", "a", 0),
        (4, None, "en", "a", None),
        (5, long, None, "b", len(long)),
        (6, "  two   words \n", "fr", "b", 14),
        (7, "word", None, None, 4),
        (None, "a row without an id that says token = abcdef123", "en", "a", 47),
        (None, None, None, None, None),
        (9, "naïve café — “déjà vu”, don't; 5th 3,4 \x1c odd\xa0space <|endoftext|>", "fr", "c", None),
    ]
    names = "score hits tile rank mark offset length piece h frame kinds bucket word cell sequence_id vector".split()
    docs = spark.createDataFrame(rows, DOCS_DDL)
    for name in names:
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS_DDL)


@pytest.fixture(scope="session")
def some_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
