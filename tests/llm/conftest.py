import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import SCHEMA, awkward  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(awkward(), SCHEMA).repartition(5).write.parquet(path)
    frame = spark.read.parquet(path)
    frame.path = path
    return frame


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    frame = spark.read.parquet(path)
    frame.path = path
    return frame
