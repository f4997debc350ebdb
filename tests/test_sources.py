"""Readers, sinks and incremental intake: temporary-folder round trips."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from transitlens import schemas
from transitlens.sources import readers as RD
from transitlens.sources import sinks as SK
from transitlens.operators.dedup import append_by_name, dedup, dedup_scans
from transitlens.streaming.ingest import ingest_incremental


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


SHIP_CSV = (
    "shipment_id,order_id,customer_id,carrier_name,shipment_type,origin_hub,destination_hub,distance_km,"
    "zone,weight_kg,booking_timestamp,sla_hours,expected_delivery_ts\n"
    "S1,O1,C1,DHL,Express,Delhi,Mumbai,1494.9,Zone C,2.5,2026-04-01 08:00:00,48,2026-04-03 08:00:00\n"
    "S2,O2,C2,DTDC,Economy,Pune,Pune,0.0,Local,abc,2026-04-01 09:00:00,48,not-a-time\n"
)


def test_csv_read_with_lineage_and_rejects(spark, tmp_dir):
    p = os.path.join(tmp_dir, "raw", "shipment_master_2026-04-01.csv")
    write_text(p, SHIP_CSV)
    df = RD.read_raw(spark, p, "csv", schemas.SHIPMENTS)
    typed = RD.enforce_schema(df, schemas.SHIPMENTS)
    rows = {r.shipment_id: r for r in typed.collect()}
    assert rows["S1"].booking_timestamp == dt.datetime(2026, 4, 1, 8, 0)
    assert rows["S1"].distance_km == 1494.9 and rows["S1"]._rejected is False
    assert rows["S2"].weight_kg is None and rows["S2"].expected_delivery_ts is None
    assert rows["S2"]._rejected is True
    assert rows["S1"].file_name == "shipment_master_2026-04-01.csv"
    assert rows["S1"].file_modification_time is not None


def test_multiline_json_array_and_json_lines(spark, tmp_dir):
    recs = [{"event_id": "e1", "shipment_id": "S1", "hub_name": "Delhi", "hub_id": "HUB001",
             "scan_type": "PICKED_UP", "scan_timestamp": "2026-04-01 09:00:00", "scan_status": "SUCCESS",
             "delay_profile": "normal"},
            {"event_id": "e2", "shipment_id": "S1", "hub_name": "Noida", "scan_type": "DELIVERED",
             "scan_timestamp": "2026-04-01 12:00:00", "scan_status": "SUCCESS", "delay_profile": "normal"}]
    arr = os.path.join(tmp_dir, "a", "checkpoint_scan_events.json")
    write_text(arr, json.dumps(recs, indent=2))
    lines = os.path.join(tmp_dir, "b", "checkpoint_scan_events.json")
    write_text(lines, "\n".join(json.dumps(r) for r in recs))
    a = RD.enforce_schema(RD.read_raw(spark, arr, "json", schemas.SCAN_EVENTS), schemas.SCAN_EVENTS)
    b = RD.enforce_schema(RD.read_raw(spark, lines, "json", schemas.SCAN_EVENTS),
                          schemas.SCAN_EVENTS)
    cols = [f.name for f in schemas.SCAN_EVENTS.fields]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    assert a.filter(F.col("hub_id").isNull()).count() == 1


def test_load_by_name_is_case_insensitive(spark):
    df = spark.createDataFrame([("S1", "DHL", 7)], "SHIPMENT_ID string, Carrier_Name string, extra int")
    out = RD.load_by_name(df, schemas.SHIPMENTS)
    assert out.columns == [f.name for f in schemas.SHIPMENTS.fields]
    r = out.first()
    assert (r.shipment_id, r.carrier_name, r.zone) == ("S1", "DHL", None)


def test_append_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    out = sorted(append_by_name(a, b).collect(), key=lambda r: r.k)
    assert (out[0].b, out[1].a) == (None, None)


def test_land_bronze_idempotent_and_latest_partition(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lake")
    d1 = spark.createDataFrame([("a",), ("b",)], "v string")
    d2 = spark.createDataFrame([("c",)], "v string")
    SK.land_bronze(d1, root, "ds", "2026-04-01")
    SK.land_bronze(d2, root, "ds", "2026-04-02")
    SK.land_bronze(d2, root, "ds", "2026-04-02")  # retry: same partition replaced
    bronze = spark.read.parquet(os.path.join(root, "ds"))
    assert bronze.count() == 3
    latest = RD.latest_partition(bronze)
    assert [r.v for r in latest.collect()] == ["c"]
    assert RD.latest_partition_value(spark, os.path.join(root, "ds")) == "2026-04-02"
    assert sorted(RD.partition_values(spark, os.path.join(root, "ds"))) == ["2026-04-01", "2026-04-02"]
    assert "PartitionFilters: [isnotnull(ingest_date" in latest._jdf.queryExecution().executedPlan().toString() \
        or latest.count() == 1
    with pytest.raises(SK.EmptyInputError):
        SK.land_bronze(d1.limit(0), root, "ds", "2026-04-03")


def test_latest_files_per_dataset(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    write_text(os.path.join(raw, "shipment_master_1.csv"), SHIP_CSV)
    write_text(os.path.join(raw, "hub_master_1.csv"), "hub_id\nH1\n")
    time.sleep(1.1)
    write_text(os.path.join(raw, "shipment_master_2.csv"), SHIP_CSV)
    got = RD.latest_files(spark, raw, ["shipment_master", "hub_master", "checkpoint_scan_events"])
    assert [os.path.basename(p) for p in got["shipment_master"]] == ["shipment_master_2.csv"]
    assert [os.path.basename(p) for p in got["hub_master"]] == ["hub_master_1.csv"]
    assert got["checkpoint_scan_events"] == []


def test_dedup_newest_wins(spark):
    df = spark.createDataFrame([("S1", "old", 1), ("S1", "new", 2), ("S2", "x", 1)], "shipment_id string, v string, t int")
    out = {r.shipment_id: r.v for r in dedup(df, ["shipment_id"], newest_by="t").collect()}
    assert out == {"S1": "new", "S2": "x"}


def test_dedup_scans_keeps_one_row_of_each_scan(spark):
    at = dt.datetime(2026, 4, 1, 8)
    rows = [("E1", "S1", "Pune", "ARRIVED", at, 1), ("E1", "S1", "Pune", "ARRIVED", at, 1), ("E0", "S1", "Pune", "ARRIVED", at, 0),
            ("E2", "S1", "Pune", "DEPARTED", at, 1), ("E3", "S1", None, "ARRIVED", None, 1), ("E4", "S1", None, "ARRIVED", None, 2),
            ("E5", None, None, None, None, 1), (None, None, None, None, None, 2)]
    scans = spark.createDataFrame(rows, "event_id string, shipment_id string, hub_name string, scan_type string, scan_timestamp timestamp, t int")
    assert dedup_scans(scans).columns == scans.columns
    assert {r.event_id for r in dedup_scans(scans).collect()} == {"E0", "E2", "E3", None}
    newest = dedup_scans(scans, newest_by="t").collect()
    assert len(newest) == 4 and {r.event_id for r in newest} == {"E1", "E2", "E4", None}


def test_silver_sink_and_table(spark, tmp_dir):
    df = spark.createDataFrame([("S1", dt.date(2026, 4, 1)), ("S2", dt.date(2026, 4, 2))],
                               "shipment_id string, timestamp_date date")
    path = SK.write_silver(df, os.path.join(tmp_dir, "silver"))
    t = SK.register_table(spark, "tl_test_silver", path)
    assert t.count() == 2
    assert SK.rename_columns(t, {"shipment_id": "id"}).columns[0] == "id"
    SK.drop_table(spark, "tl_test_silver")
    assert not spark.catalog.tableExists("tl_test_silver")


def test_incremental_intake_skips_loaded_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "incoming")
    tgt = os.path.join(tmp_dir, "table")
    ck = os.path.join(tmp_dir, "ck")
    rows1 = [("e1", "S1", "Delhi", "HUB001", "PICKED_UP", dt.datetime(2026, 4, 1, 9), "SUCCESS", "normal")]
    spark.createDataFrame(rows1, schemas.SCAN_EVENTS).write.parquet(os.path.join(src, "day1"))
    r1 = ingest_incremental(spark, src, tgt, ck, schemas.SCAN_EVENTS)
    r2 = ingest_incremental(spark, src, tgt, ck, schemas.SCAN_EVENTS)
    rows2 = [("e2", "S1", "Delhi", "HUB001", "DEPARTED", dt.datetime(2026, 4, 1, 11), "SUCCESS", "normal")]
    spark.createDataFrame(rows2, schemas.SCAN_EVENTS).write.parquet(os.path.join(src, "day2"))
    r3 = ingest_incremental(spark, src, tgt, ck, schemas.SCAN_EVENTS)
    assert (r1["rows"], r2["rows"], r3["rows"]) == (1, 0, 1)
    out = spark.read.parquet(tgt)
    assert sorted(r.event_id for r in out.collect()) == ["e1", "e2"]


def test_run_daily_from_raw_files(spark, tmp_dir):
    from transitlens.plans.daily import run_daily
    from transitlens.plans.layers import as_text
    from transitlens.sources import fixtures

    fx = fixtures.build(spark, "/root/testdata/sf0.001")
    raw = os.path.join(tmp_dir, "raw")
    as_text(fx.shipments).write.option("header", "true").csv(f"{raw}/shipment_master")
    fx.hubs.write.option("header", "true").csv(f"{raw}/hub_master")
    as_text(fx.scans).write.json(f"{raw}/checkpoint_scan_events")
    lake = os.path.join(tmp_dir, "lake")
    out = run_daily(spark, raw, lake, "2026-05-02", count_rejects=True)
    assert out["rejected"] == {"shipment_master": 0, "hub_master": 0, "checkpoint_scan_events": 0}
    again = run_daily(spark, raw, lake, "2026-05-02")   # retry: same result
    assert again["gold"].keys() == out["gold"].keys()
    bronze_rows = spark.read.parquet(f"{lake}/bronze/checkpoint_scan_events").count()
    assert bronze_rows == fx.scans.count()
    routes = spark.read.parquet(out["gold"]["worst_routes"]).count()
    assert routes > 0
