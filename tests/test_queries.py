"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from tests.compare import compare

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_oracle(spark, name):
    difference, _ = compare(spark, FOLDER, QUERIES[name], ORACLES[name])
    assert difference is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["submission_id", "id_image", "url_presigned", "formulario_moreapp"]
    assert frame.count() > 0
