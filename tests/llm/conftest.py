import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tallyhouse.llm.base import prepare  # noqa: E402

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("k", T.StringType()), T.StructField("t", T.StringType()), T.StructField("n_words", T.StringType())])


@pytest.fixture
def docs(spark):
    """Builds a table of documents with extra columns whose names clash with inner ones."""
    prepare(spark)

    def build(rows):
        return spark.createDataFrame([(i, t, "x", None, "y") for i, t in rows], DOCS)

    return build
