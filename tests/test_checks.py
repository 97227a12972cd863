"""Every registered query beside its check SQL on the smallest given tables."""

import pytest
from compare import database, difference

import __spark_entry__ as entry
from glimmerdex.plans.catalog import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("key", sorted(CHECKS))
def test_same_rows(spark, db, key):
    got = QUERIES[key](spark, SF).toPandas()
    want = db.execute(CHECKS[key]).df()
    assert difference(got, want) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(CHECKS)))
def test_rows_without_sql(spark, key):
    assert QUERIES[key](spark, SF).count() > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["query_id", "rank", "doc_key", "score"]
    assert rows.count() == 400


def test_checks_cover_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
    assert set(CHECKS) <= set(QUERIES)
    assert set(QUERIES) - set(CHECKS) == {"knn_approx", "hash_embed"}
