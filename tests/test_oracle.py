"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

from oracle_util import compare, duckdb_conn
from oracle_util import SF_SMALL

import __spark_entry__ as entry
from transitlens.plans import catalog

# the training-data queries have their own tests in tests/llm
QUERIES = {n: f for n, f in entry.queries().items() if n in catalog.QUERIES}
SQL = {n: s for n, s in entry.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["origin_hub", "destination_hub", "dark_periods"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["hub_stays", "worst_routes", "silver_dedup_counts", "worst_routes_hot_split"])
def test_lazy_path_matches_oracle(spark, con, name):
    """Same results with the layer store switched off (everything recomputed lazily)."""
    spark.conf.set("spark.transitlens.materialize", "false")
    try:
        r = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    finally:
        spark.conf.set("spark.transitlens.materialize", "true")
    assert r["ok"], r


@pytest.mark.parametrize("name", ["worst_routes", "dark_periods_by_extra_hours", "shipments_by_zone", "worst_hub_days_top5",
                                  "worst_day_each_hub"])
def test_order_of_sorted_reports(spark, con, name):
    """The rows come in the statement's order, not only as the same set."""
    got = QUERIES[name](spark, SF_SMALL)
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert [tuple(map(str, r)) for r in rows] == [tuple(map(str, r)) for r in want.fetchall()]
