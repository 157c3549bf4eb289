import pytest
from pyspark.sql import types as T

ODD = ["", None, " ", "\n\n", "a", "word", "é ü 日本 🙂", "x" * 5000, "same text here again and again " * 60, "tab\tand\vmore\r\n  spaces   here"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like those the operators add."""
    rows = [(i, x, None if i % 3 else "en", i) for i, x in enumerate(ODD)]
    rows += [(None, "a text without an id that is long enough to be cut " * 5, None, None), (3, "a", "de", 1), rows[5], rows[5], (50, rows[8][1], "en", 2)]
    schema = "doc_id long, text string, lang string, component long"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]))


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
