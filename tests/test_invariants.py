"""Invariants of SURVEY section 5.3 on the smallest scale factor."""

from pyspark.sql import functions as F

from oracle_util import SF_SMALL
from transitlens import constants as K
from transitlens import schemas
from transitlens.operators import dark as D
from transitlens.operators import sla as S
from transitlens.plans.layers import build_silver, register_views, silver_from_tables
from transitlens.sources import fixtures
from transitlens.sources import sinks as SK


def test_counting_invariants(spark):
    fx = fixtures.build(spark, SF_SMALL)
    sv = silver_from_tables(spark, SF_SMALL)
    stays = sv.stays.count()
    single = (fx.scans.groupBy("shipment_id").count().filter(F.col("count") == 2).count())
    assert stays == fx.scans.count() // 2 - single
    cats = sv.stays.groupBy("delay_category").count().agg(F.sum("count")).first()[0]
    assert cats == stays
    st = S.sla_status(sv.stays)
    delivered = sv.stays.filter(F.col("next_scan_type") == K.DELIVERED).count()
    assert st.count() == delivered == sum(r["count"] for r in st.groupBy("delivery_sla").count().collect())
    dk = D.dark_periods(sv.stays, sv.distances)
    labels = {r.visibility_status: r["count"] for r in dk.groupBy("visibility_status").count().collect()}
    assert sum(labels.values()) == stays
    assert labels[K.STARTING_POINT] == labels[K.FINAL_DELIVERY] == fx.shipments.count() - single


def test_input_row_order_does_not_change_results(spark):
    fx = fixtures.build(spark, SF_SMALL)
    a = build_silver(fx.shipments, fx.scans, fx.hubs, fx.distances).stays
    shuffled = fx.scans.orderBy(F.rand(seed=3)).repartition(5)
    b = build_silver(fx.shipments.repartition(3), shuffled, fx.hubs, fx.distances).stays
    cols = ["event_id", "next_scan_type", "duration_seconds", "delay_category", "total_time"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_views_and_silver_table(spark, tmp_dir):
    sv = silver_from_tables(spark, SF_SMALL)
    names = register_views(spark, sv, prefix="tl_")
    assert set(names) == {"tl_shipping_silver", "tl_total_time_by_hub", "tl_worst_carrier",
                          "tl_dark_periods", "tl_sla_status"}
    n = spark.sql("SELECT count(*) FROM tl_worst_carrier WHERE rnk = 1").first()[0]
    assert n == 5
    t = SK.create_silver_table(spark, "tl_silver_empty", tmp_dir + "/silver_tbl")
    assert t.schema == schemas.SILVER and t.count() == 0
    SK.drop_table(spark, "tl_silver_empty")
