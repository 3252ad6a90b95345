"""Every registered query against its oracle, and against empty tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks.compare import differences, oracle_connection
from checks.oracles import ORACLES
from curbflow.plans.catalog import registered
from curbflow.sources import starschema

FOLDER = "/root/testdata/sf0.001"
QUERIES = registered()
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def oracles():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(driver.queries()) >= set(QUERIES) and set(driver.oracle_sql()) >= set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() == 20


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_oracle(spark, oracles, name):
    answer = QUERIES[name](spark, FOLDER).toPandas()
    assert not differences(answer, oracles.execute(ORACLES[name]).df())


@pytest.fixture
def empty_tables(monkeypatch):
    full = starschema.table

    def empty(spark, folder, name):
        return full(spark, folder, name).limit(0)

    monkeypatch.setattr(starschema, "table", empty)
    monkeypatch.setattr("curbflow.plans.catalog.table", empty)


# Tables about columns or the whole input have rows even when the input has none.
ALWAYS = {"null_profile", "null_matrix", "sign_counts", "joinability", "describe_table", "ingest_quality"}
ALWAYS |= {"day_distribution_dense", "day_distribution_dense_from_20", "null_matrix_other", "describe_events", "schema_table"}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("sql_")])
def test_query_of_empty_tables(spark, empty_tables, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert bool(rows) == (name in ALWAYS)
