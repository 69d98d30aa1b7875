import pytest
from pyspark.sql import types as T

from indicator_lake.llm.shipping import ship

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("n", T.LongType()),
        T.StructField("blob", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def documents(llm):
    """Make a documents table of (doc_id, text[, source]) rows, with extra columns whose names clash."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), 7, "x", 3) for r in rows]
        return llm.createDataFrame(full, DOCUMENT)

    return make
