import pytest


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty and blank texts, repeated rows, a long text, and columns with clashing names."""
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [(1, "a plain short text here ."), (1, "a plain short text here ."), (2, None), (None, None), (None, ""), (3, "   \n"), (4, long), (5, long), (None, long[:900])]
    return spark.createDataFrame([(i, t, "x", 0.5, 7) for i, t in rows], "doc_id long, text string, spans string, score double, n_words int")
