"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from pulsebar.plans import catalogue, twins
from tests.compare import compare, connect

#: The queries on training text have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in catalogue.QUERIES}
TWINS = twins.TWINS


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(TWINS) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_twin(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, TWINS[name]) > 0


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", [name for name in QUERIES if not name.startswith("stream_")])
def test_session_zone_changes_nothing(spark, name):
    small = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        compare(QUERIES[name](spark, small), connect(small), TWINS[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
