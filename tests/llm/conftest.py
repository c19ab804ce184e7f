from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("_th", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("fp", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) pairs, with extra clashing columns."""

    def build(rows):
        full = [
            (i, t, "en", "s", None if t is None else len(t), "x", "y", "z") for i, t in rows
        ]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build
