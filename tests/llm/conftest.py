import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
ODD_TEXTS = [None, "", " \t\n", "one", "a b c", "ÄÖ ß é 漢字 🙂 end", "x" * 30_000, "word " * 20_000, "same text here again", "same text here again"]


@pytest.fixture
def documents(spark):
    """Make a documents table from texts, or from (doc_id, text[, source]) rows."""
    def make(rows):
        full = []
        for k, row in enumerate(rows):
            doc_id, text, source = ((*row, "s")[:3] if isinstance(row, tuple) else (k, row, "s"))
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)
    return make


@pytest.fixture
def odd_documents(documents):
    """Nulls in every column, empty and very long texts, repeated rows and ties."""
    rows = [(k, text) for k, text in enumerate(ODD_TEXTS)]
    return documents([*rows, (None, "no id", None), (None, None, None), (3, "one", None), (3, "one", None)])


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_documents():
    import pyarrow.parquet as pq
    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
