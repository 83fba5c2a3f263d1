"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import SF_DIR
from workload import QUERIES, SQL
from workload.tables import Tables


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    # An empty result is right for a few queries on the smallest tables.
    found = difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert found in (None, "no rows")


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["release_twice", "release_complete_studies", "release_registered_only", "release_verdicts", "missing_outputs"]
)
def test_released_rows_are_evaluated_once(spark, monkeypatch, name):
    seen = spark.sparkContext.accumulator(0)
    rows = Tables(spark, SF_DIR).keyed

    def each(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(Tables, "keyed", property(lambda t: rows.mapInArrow(each, rows.schema)))
    assert QUERIES[name](spark, SF_DIR).count() > 0
    assert seen.value == rows.count()
