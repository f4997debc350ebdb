"""Physical-plan properties the design relies on (regression guards)."""

from oracle_util import SF_SMALL

from transitlens.plans.catalog import QUERIES
from transitlens.plans.layers import silver_from_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_joins_are_broadcast_and_one_shuffle_join(spark):
    p = plan(silver_from_tables(spark, SF_SMALL, materialized=False).stays)
    assert p.count("SortMergeJoin") <= 1          # only shipments x scans
    assert p.count("BroadcastHashJoin") >= 8      # cities, hubs, distances
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # every hash shuffle is on the journey key
    for line in p.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "hashpartitioning(shipment_id" in line, line


def test_geodesic_is_not_inlined_into_filters(spark):
    from transitlens.operators import dark as D

    sv = silver_from_tables(spark, SF_SMALL, materialized=False)
    p = plan(D.worst_routes(D.dark_periods(sv.stays, sv.distances))).upper()
    assert "ASIN" not in p and "ATAN" not in p


def test_dark_reports_read_the_stored_dark_table(spark):
    df = QUERIES["worst_routes"](spark, SF_SMALL)
    assert all("/dark_periods/" in f for f in df.inputFiles())
    assert "Window" not in plan(df)


def test_scans_are_pruned(spark):
    p = plan(QUERIES["shipment_profile"](spark, SF_SMALL))
    scans = [l for l in p.splitlines() if "FileScan parquet" in l]
    assert scans
    for l in scans:
        assert "l_extendedprice" not in l and "o_totalprice" not in l and "l_comment" not in l


def test_gold_reads_materialized_silver_with_pushed_filter(spark):
    df = QUERIES["sla_status"](spark, SF_SMALL)
    p = plan(df)
    assert df.inputFiles() and all("/silver_stays/" in f for f in df.inputFiles())
    assert "PushedFilters: [IsNotNull(next_scan_type), EqualTo(next_scan_type,DELIVERED)]" in p


def test_dedup_uses_partial_aggregation(spark):
    from transitlens.operators.dedup import dedup_scans
    from transitlens.sources import fixtures

    p = plan(dedup_scans(fixtures.build(spark, SF_SMALL, with_duplicates=True).scans))
    assert "partial_min" in p


def test_scans_are_shuffled_before_dedup_sorts_them(spark, tmp_dir):
    from transitlens.operators.dedup import dedup_scans
    from transitlens.sources import fixtures

    fixtures.build(spark, SF_SMALL, with_duplicates=True).scans.write.parquet(f"{tmp_dir}/scans")
    for newest_by in (None, "scan_status"):
        p = plan(dedup_scans(spark.read.parquet(f"{tmp_dir}/scans"), newest_by))
        above, below = p.split("Exchange hashpartitioning(")     # one shuffle
        assert "Aggregate" in above and "Sort" in above
        assert "Aggregate" not in below and "Sort" not in below  # a task that reads files keeps no rows
