"""Hot shipment ids: the split window path must equal the plain one, row for row."""

import datetime as dt

from pyspark.sql import functions as F

from transitlens import schemas
from transitlens.operators import dark as D
from transitlens.operators.skew import detect_hot_keys, hot_key_frame, with_neighbors
from transitlens.plans.layers import build_silver
from transitlens.sources import reference as R

CITIES = ["Delhi", "Jaipur", "Mumbai", "Agra", "Pune", "Noida"]
HUBS = {"Delhi": "HUB001", "Jaipur": "HUB010", "Mumbai": "HUB002", "Pune": "HUB009"}


def journey(sid, start, visits, step_min=37, dwell_min=95):
    rows, t = [], start
    for i in range(visits):
        city = CITIES[(i * 7 + len(sid)) % len(CITIES)]
        a_type = "PICKED_UP" if i == 0 else "ARRIVED"
        d_type = "DELIVERED" if i == visits - 1 else "DEPARTED"
        rows.append((f"{sid}-{i:05d}A", sid, city, HUBS.get(city), a_type, t, "SUCCESS", "minor"))
        t2 = t + dt.timedelta(minutes=dwell_min + (i % 5) * 13)
        rows.append((f"{sid}-{i:05d}D", sid, city, HUBS.get(city), d_type, t2, "SUCCESS", "minor"))
        t = t2 + dt.timedelta(minutes=step_min + (i % 7) * 11)
    return rows


def frames(spark):
    start = dt.datetime(2026, 4, 1, 0, 0)
    scans = journey("HOT", start, 1500)                       # ~2,000 hours, 3,000 scans
    for k in range(40):
        scans += journey(f"N{k}", start + dt.timedelta(hours=k), 3 + k % 4)
    scans.append(("HOT-tie", "HOT", "Delhi", "HUB001", "ARRIVED", start, "SUCCESS", "minor"))  # tie on time
    ships = [(s, "O", "C", "DHL", "Standard", "Delhi", "Pune", 1200.0, "Zone C", 1.0, start, 96,
              start + dt.timedelta(hours=96)) for s in ["HOT"] + [f"N{k}" for k in range(40)]]
    return (spark.createDataFrame(ships, schemas.SHIPMENTS),
            spark.createDataFrame(scans, schemas.SCAN_EVENTS))


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_detect_hot_keys_finds_the_hot_journey(spark):
    _, sc = frames(spark)
    assert detect_hot_keys(sc, "shipment_id", min_share=0.2, fraction=0.5) == ["HOT"]
    assert detect_hot_keys(sc, "shipment_id", min_share=0.0001, fraction=0.5) == ["HOT"]   # noise floor
    assert detect_hot_keys(sc, "shipment_id", fraction=1.0, top=2)[0] == "HOT"


def test_with_neighbors_split_equals_plain(spark):
    _, sc = frames(spark)
    hot = hot_key_frame(spark, "shipment_id", ["HOT"])
    args = ("shipment_id", ["scan_timestamp", "event_id"],
            {"nt": "scan_type", "nts": "scan_timestamp"}, {"ph": "hub_name"})
    plain = with_neighbors(sc, *args)
    split = with_neighbors(sc, *args, hot=hot, bucket_seconds=3 * 3600)
    cols = ["event_id", "nt", "nts", "ph"]
    assert rows(plain, cols) == rows(split, cols)


def test_silver_and_dark_with_hot_keys_equal_plain(spark):
    sh, sc = frames(spark)
    hubs, dist = R.hub_master(spark), R.city_distances(spark)
    plain = build_silver(sh, sc, hubs, dist)
    split = build_silver(sh, sc, hubs, dist, hot_keys=["HOT"])
    cols = ["event_id", "next_scan_type", "next_scan_timestamp", "duration_seconds", "delay_category", "total_time"]
    assert rows(plain.stays, cols) == rows(split.stays, cols)
    assert plain.stays.filter(F.col("shipment_id") == "HOT").count() > 1000
    hot = hot_key_frame(spark, "shipment_id", ["HOT"])
    dcols = ["event_id", "prev_hub", "hop_distance_km", "actual_total_time", "visibility_status"]
    assert rows(D.dark_periods(plain.stays, dist), dcols) == rows(D.dark_periods(split.stays, dist, hot=hot), dcols)


def test_collisions_null_times_and_ties_are_alike_on_both_paths(spark):
    """Colliding shipment rows, scans without a time and equal times: hot and plain agree, and no scan meets its own copy."""
    from transitlens.operators.silver import shipment_scans, with_next_scan

    ships, scans = frames(spark)
    ships = ships.unionByName(ships.withColumn("carrier_name", F.lit("ZZZ")).withColumn("order_id", F.lit("O2")))
    odd = [("HOT-n1", "HOT", "Agra", None, "ARRIVED", None, "SUCCESS", "minor"),
           ("HOT-n2", "HOT", "Pune", "HUB009", "DEPARTED", None, "SUCCESS", "minor"),
           ("HOT-tie", "HOT", "Agra", None, "DEPARTED", dt.datetime(2026, 4, 1), "SUCCESS", "minor")]
    scans = scans.unionByName(spark.createDataFrame(odd, schemas.SCAN_EVENTS))
    hot = hot_key_frame(spark, "shipment_id", ["HOT"])
    out = []
    for h in (None, hot):
        rows = with_next_scan(shipment_scans(ships, scans, h), h).select(
            "shipment_id", "event_id", "order_id", "scan_type", "hub_name", "next_scan_type", "next_scan_timestamp").collect()
        out.append(sorted(map(str, rows)))
    assert out[0] == out[1]
    assert len(out[0]) == scans.count()


def test_scan_sequence_of_hot_keys(spark):
    from transitlens.operators.profile import scan_sequence

    _, scans = frames(spark)
    scans = scans.unionByName(spark.createDataFrame(
        [("HOT-n", "HOT", "Agra", None, "ARRIVED", None, "SUCCESS", "minor")], schemas.SCAN_EVENTS))
    plain = scan_sequence(scans).select("shipment_id", "event_id", "scan_seq")
    split = scan_sequence(scans, hot_key_frame(spark, "shipment_id", ["HOT"])).select("shipment_id", "event_id", "scan_seq")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_one_hour_journey_split(spark):
    """All rows within two minutes, fewer than a segment holds."""
    start = dt.datetime(2026, 4, 1, 0, 0)
    rows = [(f"e{k:03d}", "HOT", CITIES[k % 6], None, "ARRIVED", start + dt.timedelta(seconds=k // 2), "SUCCESS", "minor") for k in range(200)]
    df = spark.createDataFrame(rows, schemas.SCAN_EVENTS)
    args = ("shipment_id", ["scan_timestamp", "event_id"], {"n": "hub_name"}, {"p": "hub_name"})
    plain = with_neighbors(df, *args).select("event_id", "n", "p")
    split = with_neighbors(df, *args, hot_key_frame(spark, "shipment_id", ["HOT"])).select("event_id", "n", "p")
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def one_instant(spark):
    """A journey of 6,000 scans within one hour, a third at one instant, a third without a time, and a small journey."""
    start = dt.datetime(2026, 4, 1, 9, 0)
    when = [None, start + dt.timedelta(minutes=30), None]
    rows = [(f"e{(k * 7919) % 6000:05d}", "HOT", CITIES[k % 6], None, "ARRIVED", start + dt.timedelta(milliseconds=k * 500) if k % 3 == 0 else when[k % 3],
             "SUCCESS", "minor") for k in range(6000)]
    rows += [(f"n{k}", "N", CITIES[k % 6], None, "ARRIVED", start + dt.timedelta(seconds=k), "SUCCESS", "minor") for k in range(5)]
    return spark.createDataFrame(rows, schemas.SCAN_EVENTS).repartition(8)


def test_segments_of_one_hour_are_even_and_ordered(spark):
    """Segments follow the order, also among equal and missing times, and none holds much more than its share."""
    from transitlens.operators.skew import with_segment

    order = ["scan_timestamp", "event_id"]
    df = one_instant(spark)
    out = with_segment(df, "shipment_id", order, "seg", segment_rows=50)
    got = [(r["scan_timestamp"] or dt.datetime.min, r["event_id"], r["seg"]) for r in out.filter("shipment_id = 'HOT'").collect()]
    assert len(got) == 6000 and out.columns == [*df.columns, "seg"]
    segs = [s for _, _, s in sorted(got)]
    assert segs == sorted(segs)
    sizes = [segs.count(s) for s in set(segs)]
    assert len(sizes) > 80 and max(sizes) < 200          # more than FAN borders, both levels are used
    assert {r["seg"] for r in out.filter("shipment_id = 'N'").collect()} == {0}


def test_one_hour_journey_is_spread_and_equals_plain(spark):
    from transitlens.operators.skew import with_sequence

    df, hot = one_instant(spark), hot_key_frame(spark, "shipment_id", ["HOT"])
    args = ("shipment_id", ["scan_timestamp", "event_id"], {"n": "hub_name", "nts": "scan_timestamp"}, {"p": "hub_name"})
    cols = ["event_id", "n", "nts", "p"]
    plain = with_neighbors(df, *args).select(*cols)
    split = with_neighbors(df, *args, hot=hot, segment_rows=100).select(*cols)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    seq = with_sequence(df, "shipment_id", ["scan_timestamp", "event_id"], "n").select("event_id", "n")
    seq_split = with_sequence(df, "shipment_id", ["scan_timestamp", "event_id"], "n", hot, segment_rows=100).select("event_id", "n")
    assert sorted(map(tuple, seq.collect())) == sorted(map(tuple, seq_split.collect()))


def test_segments_of_nothing_and_of_repeated_rows(spark):
    from transitlens.operators.skew import with_segment

    order = ["scan_timestamp", "event_id"]
    none = spark.createDataFrame([], schemas.SCAN_EVENTS)
    assert with_segment(none, "shipment_id", order, "seg", segment_rows=10).collect() == []
    same = spark.createDataFrame([("e", "HOT", "Agra", None, "ARRIVED", dt.datetime(2026, 4, 1), "SUCCESS", "minor")] * 500, schemas.SCAN_EVENTS)
    assert {r["seg"] for r in with_segment(same, "shipment_id", order, "seg", segment_rows=10).collect()} == {1}


def test_many_segments_are_found_by_halving(spark):
    """More borders than a row should be compared with: no expression runs over all of them, and operators can share the segments."""
    from transitlens.operators.skew import with_segment, with_sequence

    order, df = ["scan_timestamp", "event_id"], one_instant(spark)
    cut = with_segment(df, "shipment_id", order, "seg", segment_rows=10)
    assert "lambda" not in cut._jdf.queryExecution().optimizedPlan().toString()
    hot = hot_key_frame(spark, "shipment_id", ["HOT"])
    args = ("shipment_id", order, {"n": "hub_name"}, {"p": "hub_name"})
    cols = ["event_id", "n", "p", "at"]
    plain = with_sequence(with_neighbors(df, *args), "shipment_id", order, "at").select(*cols)
    split = with_sequence(with_neighbors(cut, *args, hot, segment="seg"), "shipment_id", order, "at", hot, segment="seg").select(*cols)
    assert cut.agg(F.count_distinct("seg")).first()[0] > 300
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
