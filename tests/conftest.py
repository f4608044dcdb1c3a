import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall import sample  # noqa: E402
from rollcall.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "*",
        4,
        spark__checkpoint__dir=base / "shared",
        spark__sql__warehouse__dir=base / "warehouse",
    )
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    return sample.database(spark, {})


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def set_conf(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield set_conf
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def star(spark):
    """A small star: lists of rows -> the three frames."""

    def build(hires, departments=((1, "Sales"), (2, "Law")), jobs=((1, "Clerk"), (2, "Lead"))):
        rows = [(i, f"emp {i}", *hire) for i, hire in enumerate(hires, 1)]
        fact = "id BIGINT, name STRING, datetime STRING, department_id BIGINT, job_id BIGINT"
        return (
            spark.createDataFrame(rows, fact),
            spark.createDataFrame(list(departments), "id BIGINT, department STRING"),
            spark.createDataFrame(list(jobs), "id BIGINT, job STRING"),
        )

    return build
