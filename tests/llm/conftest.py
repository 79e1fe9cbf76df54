import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("words", "fp", "row", "tokens", "epoch", "base", "copies", "k", "f", "root", "piece", "shard", "key")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ties."""
    prose = "the cat and the dog went to the house of a friend in town and it was late for them all"
    rows = [
        (1, None, "en", "src1", None),
        (2, "", "en", "src1", 0),
        (3, " \t\n ", None, None, 4),
        (None, prose, "en", "src2", 1),
        (None, prose, "en", "src2", 1),
        (4, prose, None, "src3", 2),
        (4, prose, None, "src3", 2),
        (4, "x", "de", "noname", 1),
        (5, "word " * 60_000, "fr", "src4", 300_000),
        (6, "9" * 50_000, "fr", "src4", 50_000),
        (7, "a.b-c@d.ef 1.2.3.4 +49 30 123456789 4111 1111 1111 1111 <|endoftext|> é", "es", "src0", 80),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
