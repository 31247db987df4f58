import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """A frame of documents from (doc_id, text, lang, source) tuples, with columns named as operators name theirs."""

    def make(rows):
        rows = [tuple(r) + ("en", "a")[len(r) - 2 :] for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
            "*", "1 AS row", "'x' AS key", "true AS kept", "'y' AS h", "2 AS n_tokens", "'z' AS bucket", "3 AS size"
        )

    return make


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
