from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumenrec.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), …)`` → DataFrame."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples (nulls first)."""
    return lambda df, *cols: sorted(
        (tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda t: [(v is not None, str(type(v)), v) for v in t]
    )
