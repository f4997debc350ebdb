"""Column functions on hand-made rows: every boundary from FIXTURES.md section 5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from transitlens import constants as K
from transitlens.functions.classify import delay_category, delivery_sla, sla_hours, visibility_status, zone
from transitlens.functions.numeric import pct2, ratio2, round_div_int
from transitlens.functions.temporal import hour_boundary_diff


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_delay_category_boundaries(spark):
    got = one(spark, [(1.0,), (1.01,), (4.0,), (4.01,), (-3.0,), (None,)], "d double", delay_category("d"))
    assert got == ["normal", "minor_delay", "minor_delay", "major_delay", "normal", "major_delay"]


def test_zone_boundaries(spark):
    got = one(spark, [(0.0,), (50.0,), (50.1,), (300.0,), (800.0,), (1500.0,), (1500.1,)], "d double", zone("d"))
    assert got == ["Local", "Local", "Zone A", "Zone A", "Zone B", "Zone C", "Zone D"]


def test_sla_rate_card_all_cells(spark):
    rows = [(z, t) for z in K.SLA_RATE_CARD for t in K.SHIPMENT_TYPES] + [("Zone X", "Express")]
    got = one(spark, rows, "z string, t string", sla_hours("z", "t"))
    want = [h for z in K.SLA_RATE_CARD for h in K.SLA_RATE_CARD[z]] + [None]
    assert got == want


def test_delivery_sla_ties_and_nulls(spark):
    t0 = dt.datetime(2026, 4, 1, 10, 0)
    rows = [(t0, t0 + dt.timedelta(hours=1)), (t0 + dt.timedelta(hours=1), t0), (t0, t0), (None, t0)]
    got = one(spark, rows, "e timestamp, a timestamp", delivery_sla("e", "a"))
    assert got == [K.SLA_BREACH, K.SLA_COMPLETED, K.SLA_EXACT, K.SLA_EXACT]


def test_hour_boundary_diff(spark):
    d = dt.datetime
    rows = [(d(2026, 4, 1, 13, 59), d(2026, 4, 1, 14, 1)),
            (d(2026, 4, 1, 14, 0), d(2026, 4, 1, 14, 59)),
            (d(2026, 4, 1, 23, 30), d(2026, 4, 2, 2, 10)),
            (d(2026, 4, 1, 1, 0), None)]
    assert one(spark, rows, "a timestamp, b timestamp", hour_boundary_diff("a", "b")) == [1, 0, 3, None]


def test_total_time_rounds_half_away_from_zero(spark):
    # dwell - expected = 2.5 h and -2.5 h, in seconds
    got = one(spark, [(9000,), (-9000,), (8999,), (0,)], "s long", round_div_int("s", F.lit(3600)))
    assert got == [3, -3, 2, 0]


def test_ratio2_half_up_and_nullif(spark):
    rows = [(1, 8), (2, 3), (5, 0), (0, 4)]
    got = one(spark, rows, "n long, d long", ratio2("n", "d"))
    assert got == [0.13, 0.67, None, 0.0]
    assert one(spark, [(1, 3)], "p long, w long", pct2("p", "w")) == [33.33]


def test_visibility_rules_in_order(spark):
    rows = [
        (0.0, None, 5, 0.0),      # first stay
        (120.0, "A", None, 3.0),  # last stay
        (0.0, "A", 4, 0.0),       # same hub twice
        (0.0, "A", None, 0.0),    # last stay at the same hub: rule order -> final
        (693.0, "A", 18, 17.0),   # gap above expected
        (693.0, "A", 17, 17.0),   # gap equal to expected
    ]
    got = one(spark, rows, "hop double, prev string, act long, exp double",
              visibility_status("hop", "prev", "act", "exp"))
    assert got == [K.STARTING_POINT, K.FINAL_DELIVERY, K.SAME_HUB, K.FINAL_DELIVERY, K.DARK_PERIOD,
                   K.NORMAL_VISIBILITY]


def test_expected_travel_hours_for_693_km(spark):
    assert one(spark, [(693.0,)], "km double", F.round(F.col("km") / F.lit(K.TRUCK_SPEED_KMPH))) == [17.0]


def test_city_distances_symmetric_and_plausible(spark):
    from transitlens.sources.reference import city_distances

    d = {(r.from_city, r.to_city): r.road_km for r in city_distances(spark).collect()}
    assert len(d) == 40 * 39
    assert all(d[(a, b)] == d[(b, a)] for a, b in d)
    # Delhi - Mumbai is about 1,150 km as the crow flies
    assert 1450 < d[("Delhi", "Mumbai")] < 1550
    assert all(v > 0 for v in d.values())


@pytest.mark.parametrize("a,b", [("Delhi", "Noida"), ("Chennai", "Bengaluru"), ("Kochi", "Guwahati")])
def test_route_distances_matches_reference_table(spark, a, b):
    from transitlens.operators.enrich import route_distances
    from transitlens.sources.reference import cities, city_distances

    pairs = spark.createDataFrame([(a, b), (a, b)], "from_city string, to_city string")
    got = route_distances(pairs, cities(spark)).collect()
    want = city_distances(spark).filter((F.col("from_city") == a) & (F.col("to_city") == b)).collect()
    assert len(got) == 1 and got[0].road_km == want[0].road_km


def test_sla_card_join_equals_case_and_flags_unknown(spark):
    from transitlens.operators.enrich import with_sla_from_card
    from transitlens.sources.reference import sla_rate_card

    rows = [(z, t) for z in K.SLA_RATE_CARD for t in K.SHIPMENT_TYPES] + [("Zone X", "Express")]
    df = spark.createDataFrame(rows, "zone string, shipment_type string")
    got = {(r.zone, r.shipment_type): (r.sla_hours, r.sla_unknown)
           for r in with_sla_from_card(df, sla_rate_card(spark)).collect()}
    case = {(r.zone, r.shipment_type): r.h for r in df.select("*", sla_hours("zone", "shipment_type").alias("h")).collect()}
    assert all(got[k][0] == case[k] for k in case)
    assert got[("Zone X", "Express")] == (None, True) and got[("Local", "Express")] == (12, False)
