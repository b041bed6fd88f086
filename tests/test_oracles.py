"""Every registered query against its SQL on the smallest sample."""

from __future__ import annotations

import pytest

from lumenrec.plans import catalogue
from tests.compare import differences, duck

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    assert differences(catalogue.QUERIES[name](spark, DATA), con, catalogue.ORACLES[name]) == []
