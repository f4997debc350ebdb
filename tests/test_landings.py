"""Several landings, raw columns by name, newest files, the quarantine, views and distances."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from transitlens import constants as K
from transitlens import schemas
from transitlens.plans import daily, layers, oracle
from transitlens.sources import readers as RD
from transitlens.sources import reference as R
from transitlens.sources.sinks import by_date


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """A few rows need no more tasks and buckets."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def _ship(sid):
    t = dt.datetime(2026, 4, 1)
    return (sid, "O" + sid, "C", "DHL", "Standard", "Delhi", "Pune", 1200.0, "Zone C", 1.0, t, 96, t + dt.timedelta(hours=96))


def _scan(eid, sid, hub, kind, when):
    return (eid, sid, hub, None, kind, when, "SUCCESS", "minor")


def _land(spark, raw, ds, ships, scans):
    """One raw landing: shipments and hubs as CSV, scans as JSON lines; timestamps as text."""
    ship = layers.as_text(spark.createDataFrame([_ship(s) for s in ships], schemas.SHIPMENTS))
    ship.coalesce(1).write.option("header", "true").csv(f"{raw}/{ds}/shipment_master")
    layers.as_text(R.hub_master(spark)).coalesce(1).write.option("header", "true").csv(f"{raw}/{ds}/hub_master")
    spark.createDataFrame(scans, schemas.as_text(schemas.SCAN_EVENTS)).coalesce(1).write.json(f"{raw}/{ds}/checkpoint_scan_events")


A = [_scan("a1", "A", "Delhi", "PICKED_UP", "2026-04-01 08:00:00"), _scan("a2", "A", "Delhi", "DEPARTED", "2026-04-01 12:00:00"),
     _scan("a3", "A", "Agra", "ARRIVED", "2026-04-05 01:00:00")]
A_LATER = [_scan("a4", "A", "Agra", "DEPARTED", "2026-04-06 02:00:00"), _scan("a5", "A", "Pune", "ARRIVED", "2026-04-07 02:00:00"),
           _scan("a6", "A", "Pune", "DELIVERED", "2026-04-07 09:00:00")]
B = [_scan("b1", "B", "Noida", "PICKED_UP", "2026-04-05 08:00:00"), _scan("b2", "B", "Noida", "DEPARTED", "2026-04-05 12:00:00")]
C = [_scan("c1", "C", "Delhi", "PICKED_UP", "2026-04-05 03:00:00"), _scan("c2", "C", "Delhi", "DEPARTED", "2026-04-05 05:00:00")]


def _stays(spark, lake):
    return sorted(r.event_id for r in daily.tables(spark, lake)[0].read().collect())


def test_two_landings(spark, tmp_dir):
    """A journey over two days is rebuilt whole, other journeys' stays of the same dates stay, reruns change nothing."""
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    _land(spark, raw, "2026-04-05", ["A", "C"], A + C)
    daily.run_daily(spark, raw, lake, "2026-04-05")
    assert _stays(spark, lake) == ["a1", "c1"]
    _land(spark, raw, "2026-04-07", ["B"], B + A_LATER + A[:1])
    daily.run_daily(spark, raw, lake, "2026-04-07")
    whole = ["a1", "a3", "a5", "b1", "c1"]
    assert _stays(spark, lake) == whole
    for ds in ("2026-04-05", "2026-04-07", "2026-04-05"):
        daily.run_daily(spark, raw, lake, ds)
        assert _stays(spark, lake) == whole
    assert not os.path.exists(f"{lake}/_work/2026-04-05")


def test_landing_replaced_by_a_smaller_one(spark, tmp_dir):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    _land(spark, raw, "2026-04-05", ["A", "B"], A + B)
    daily.run_daily(spark, f"{raw}/2026-04-05", lake, "2026-04-05")
    assert _stays(spark, lake) == ["a1", "b1"]
    _land(spark, f"{raw}/again", "2026-04-05", ["A"], A)
    daily.run_daily(spark, f"{raw}/again", lake, "2026-04-05")
    assert _stays(spark, lake) == ["a1"]
    assert not os.path.exists(f"{lake}/silver/stays/timestamp_date=2026-04-05")


def test_quarantine_of_the_date_that_ran(spark, tmp_dir):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    broken = _scan("a9", "A", "Mumbai", "ARRIVED", "not a time")
    _land(spark, raw, "2026-04-05", ["A"], [*A, broken])
    out = daily.run_daily(spark, raw, lake, "2026-04-05", count_rejects=True)
    assert out["rejected"] == {"shipment_master": 0, "hub_master": 0, "checkpoint_scan_events": 1}
    row = spark.read.parquet(f"{lake}/quarantine/checkpoint_scan_events").first()
    assert (row.event_id, row._reject_reason) == ("a9", "scan_timestamp")
    assert _stays(spark, lake) == ["a1"]
    _land(spark, raw, "2026-04-07", ["B"], B)
    daily.run_daily(spark, raw, lake, "2026-04-07")
    assert daily.rejected_counts(spark, lake, "2026-04-05")["checkpoint_scan_events"] == 1
    assert daily.rejected_counts(spark, lake, "2026-04-07")["checkpoint_scan_events"] == 0


def test_files_per_date(spark, tmp_dir):
    df = spark.range(1000).select(F.date_add(F.lit("2026-04-01").cast("date"), (F.col("id") % 7).cast("int")).alias("timestamp_date"),
                                  F.col("id").cast("string").alias("shipment_id"), F.lit("e").alias("event_id")).repartition(16)
    by_date(df, rows_per_file=100).write.partitionBy("timestamp_date").parquet(f"{tmp_dir}/t")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/t") for f in names if f.endswith(".parquet")]
    assert len(files) <= 14 and spark.read.parquet(f"{tmp_dir}/t").count() == 1000


def test_csv_columns_by_header(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/x")
    names = [f.name for f in schemas.SHIPMENTS.fields]
    values = {n: f"v_{n}" for n in names}
    for k, order in enumerate((names, names[::-1], [n.upper() for n in sorted(names)])):
        with open(f"{tmp_dir}/x/{k}.csv", "w") as f:
            f.write(",".join(order) + "\n" + ",".join(values[n.lower()] for n in order) + "\n")
    paths = [f"{tmp_dir}/x/{k}.csv" for k in range(3)]
    rows = RD.read_raw(spark, paths, "csv", schemas.SHIPMENTS, lineage=False).collect()
    assert [r.asDict() for r in rows] == [values] * 3
    with open(f"{tmp_dir}/x/short.csv", "w") as f:
        f.write("shipment_id\nS1\n")
    with pytest.raises(RD.MissingColumnError):
        RD.read_raw(spark, f"{tmp_dir}/x/short.csv", "csv", schemas.SHIPMENTS)


def test_json_keys_in_any_case_and_broken_records(spark, tmp_dir):
    with open(f"{tmp_dir}/a.json", "w") as f:
        f.write('[{"EVENT_ID": "e1", "Shipment_Id": "S", "scan_timestamp": "2026-04-01 00:00:00"},\n {"event_id": 7}]')
    df = RD.enforce_schema(RD.read_raw(spark, f"{tmp_dir}/a.json", "json", schemas.SCAN_EVENTS), schemas.SCAN_EVENTS)
    assert [(r.event_id, r.shipment_id, r._rejected) for r in df.collect()] == [("e1", "S", False), ("7", None, False)]
    with open(f"{tmp_dir}/b.json", "w") as f:
        f.write('{"event_id": "e1"}\nno json\n\n{"Event_ID": "e2"}\n')
    df = RD.enforce_schema(RD.read_raw(spark, f"{tmp_dir}/b.json", "json", schemas.SCAN_EVENTS), schemas.SCAN_EVENTS)
    assert sorted((r.event_id or "", r._reject_reason) for r in df.collect()) == [("", "_corrupt_record"), ("e1", None), ("e2", None)]


def test_parquet_with_text_timestamps(spark, tmp_dir):
    rows = spark.createDataFrame([("e1", "S", "2026-04-01 10:00:00"), ("e2", "S", "soon")], "event_id string, shipment_id string, scan_timestamp string")
    for n in ("hub_name", "hub_id", "scan_type", "scan_status", "delay_profile"):
        rows = rows.withColumn(n.upper(), F.lit("x"))
    rows.write.parquet(f"{tmp_dir}/p")
    df = RD.enforce_schema(RD.read_raw(spark, f"{tmp_dir}/p", "parquet", schemas.SCAN_EVENTS), schemas.SCAN_EVENTS)
    assert sorted((r.event_id, str(r.scan_timestamp), r._rejected, r.hub_id) for r in df.collect()) \
        == [("e1", "2026-04-01 10:00:00", False, "x"), ("e2", "None", True, "x")]


def test_newest_landing_keeps_ties_and_all_files(spark, tmp_dir):
    def file(path, age):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        open(path, "w").write("x")
        os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))

    for name, age in (("hub_master_1.csv", 0), ("hub_master_2.csv", 0), ("hub_master_0.csv", 50), ("hub_master_old.csv", -99),
                      ("shipment_master/one.csv", 0), ("shipment_master/two.csv", 10), ("shipment_master/note.txt", -5),
                      ("shipment_master_20260101/old.csv", 70)):
        file(f"{tmp_dir}/{name}", age)
    found = RD.latest_files(spark, tmp_dir, ["hub_master", "shipment_master", "none"], "*.csv")
    tails = {k: [p.split("/")[-1] for p in v] for k, v in found.items()}
    assert tails == {"hub_master": ["hub_master_1.csv", "hub_master_2.csv"], "shipment_master": ["shipment_master"], "none": []}


def test_newest_dated_folder(spark, tmp_dir):
    for d in ("2026-04-30", "2026-05-02", "2026-05-10", "notes"):
        os.makedirs(f"{tmp_dir}/{d}")
    assert RD.latest_dated_folder(spark, tmp_dir).endswith("2026-05-10")
    assert RD.latest_dated_folder(spark, tmp_dir, "2026-05-09").endswith("2026-05-02")
    assert RD.latest_dated_folder(spark, f"{tmp_dir}/notes") == f"{tmp_dir}/notes"


def test_stream_counts_every_batch(spark, tmp_dir):
    """More micro-batches than Spark keeps progress reports for."""
    from transitlens.streaming.ingest import ingest_incremental

    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        spark.createDataFrame([(f"e{k}",) for k in range(12)], "event_id string").repartition(6).write.json(f"{tmp_dir}/s")
        got = ingest_incremental(spark, f"{tmp_dir}/s", f"{tmp_dir}/t", f"{tmp_dir}/c", schemas.SCAN_EVENTS, "json",
                                 max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert got["batches"] > 3 and got["rows"] == 12 == spark.read.parquet(f"{tmp_dir}/t").count()


def test_all_distances_equal_an_independent_geodesic(spark):
    mine = {(r.from_city, r.to_city): r.road_km for r in R.city_distances(spark).collect()}
    at = {c: (la, lo) for c, la, lo in K.CITIES}
    want = {(a, b): round(oracle._geodesic_km(*at[a], *at[b]) * K.ROAD_FACTOR, 1) for a, b in mine}
    assert len(mine) == 1560 and mine == want


def test_persisted_views(spark, tmp_dir):
    dark = spark.createDataFrame([("S1", "e1", 2.0), ("S2", "e2", 9.0), ("S3", "e3", None)], "shipment_id string, event_id string, extra_hrs double")
    carrier = spark.createDataFrame([("DHL", 1), ("DTDC", 2)], "carrier_name string, rnk int")
    dark.write.parquet(f"{tmp_dir}/dark_periods")
    carrier.write.parquet(f"{tmp_dir}/carrier_delay")
    names = layers.persist_views(spark, tmp_dir)
    assert [r.shipment_id for r in spark.table("dark_by_extra_hours").collect()] == ["S2", "S1"]
    assert [r.carrier_name for r in spark.table("worst_carrier").collect()] == ["DHL"]
    for n in names:
        spark.sql(f"DROP VIEW {n}")
    for n in ("dark_periods", "carrier_delay"):
        spark.sql(f"DROP TABLE {n}")
