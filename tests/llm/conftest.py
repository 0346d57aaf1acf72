"""A small table of awkward documents that every operator must take."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import CLASHES, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        schema = "doc_id bigint, text string, lang string, " + ", ".join(f"{c} int" for c in CLASHES)
        data = [tuple(r) + tuple(range(len(CLASHES))) for r in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def odd(make_docs, spark, tmp_path_factory):
    """Written, as operators expect a table that reads the same twice."""
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    make_docs(ROWS).repartition(3, "text").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(make_docs):
    return make_docs([])
