import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.llm.texts import ship_code  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_code(spark)


@pytest.fixture(scope="session")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.fixture
def make_docs(spark):
    """Texts (or (doc_id, text) pairs) -> documents in two partitions."""

    def build(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(2)

    return build
