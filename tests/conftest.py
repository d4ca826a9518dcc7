import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "rollcall-tests",
        cores="8",
        **{
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "3",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Small frame from a schema text and rows."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows_of(df):
    """Rows as sorted tuples, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
