import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """A documents table from texts (ids from 1), in several partitions."""

    def make(texts, ids=None):
        ids = ids or range(1, len(texts) + 1)
        rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make


@pytest.fixture
def sf_texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
