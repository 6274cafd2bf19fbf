import re

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of texts (ids 0, 1, ...), or of (doc_id, text) pairs."""

    def make(texts, lang="en", partitions=3):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def sample():
    """Texts of the smallest documents table, in id order."""
    import pyarrow.dataset as ds

    t = ds.dataset("/root/testdata/sf0.001/documents.parquet").to_table(columns=["doc_id", "text"]).to_pandas()
    return list(t.sort_values("doc_id").itertuples(index=False, name=None))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
