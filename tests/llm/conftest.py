import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of documents with further columns, some of them named like columns that operators add."""

    def make(rows):
        docs = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string")
        return docs.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "score": F.lit(1), "size": F.lit(2), "shard": F.lit(3), "kept": F.lit("x")})

    return make
