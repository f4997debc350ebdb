"""Shipments and scan events derived from the driver's star-schema tables.

One shipment per order that has line items; one hub visit per line item,
two scans (arrival, departure) per visit. The mapping uses integer
arithmetic only, so the DuckDB oracle can rebuild exactly the same rows.

Layout: the line items are hash-partitioned by ``shipment_id`` once, for the visit
window (:func:`visit_rows`), as numbers beside that id; shipments and scans are
projections of that frame, which add the texts that they need. When the bronze
layer is stored (plans.layers), the visit rows are written once and both
tables are derived from the file; downstream, the shipment x scan join, the
lead/lag windows and the de-duplication all cluster on shipment_id.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitlens import constants as K
from transitlens.functions.temporal import add_minutes
from transitlens.operators.enrich import with_hub_id, with_road_distance, with_zone_sla
from transitlens.sources import reference as R

# Start of the 30-day booking window and its length in minutes.
BOOKING_START = "2026-03-21 00:00:00"
BOOKING_SPAN_MIN = 43200
# Orders whose scans are landed twice for the de-duplication check.
DUPLICATE_EVERY = 97


class Fixture(NamedTuple):
    shipments: DataFrame
    scans: DataFrame
    hubs: DataFrame
    cities: DataFrame
    distances: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sid(key: str) -> F.Column:
    return F.concat(F.lit("SHP-"), F.col(key).cast("string"))


def visits(lineitem: DataFrame) -> DataFrame:
    """One row per line item = one hub visit, ordered inside its order."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity").withColumn("shipment_id", _sid("l_orderkey"))
    w = Window.partitionBy("shipment_id").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    dwell_h, travel_h = F.col("l_quantity").cast("bigint") % 20 + 1, F.col("l_partkey") % 30 + 2
    city = lambda key: (key % 40).cast("int")
    # what follows from a row's own columns is computed after the window, so the shuffle carries those columns alone
    v = li.withColumns({
        "seq": F.row_number().over(w),
        "n": F.count(F.lit(1)).over(whole),
        "base_min": F.coalesce(F.sum(dwell_h * 60 + travel_h * 60).over(before), F.lit(0)),
        "_first": F.first("l_suppkey").over(whole),
        "_last": F.last("l_suppkey").over(whole),
    })
    return v.select("shipment_id", "l_orderkey", "seq", "n", "base_min", (F.col("l_suppkey") % 60).alias("am"), (F.col("l_partkey") % 60).alias("dm"),
                    dwell_h.alias("dwell_h"), city(F.col("l_suppkey")).alias("city_ix"),
                    city(F.col("_first")).alias("origin_ix"), city(F.col("_last")).alias("dest_ix"))


def order_attributes(vs: DataFrame) -> DataFrame:
    """Add the other shipment attributes of each row's order (ids, booking time, carrier, type, profile)."""
    carrier = None
    for i, name in enumerate(K.CARRIERS):
        cond = (F.col("o_custkey") % len(K.CARRIERS)) == i
        carrier = F.when(cond, F.lit(name)) if carrier is None else carrier.when(cond, F.lit(name))
    m8, m10 = F.col("l_orderkey") % 8, F.col("l_orderkey") % 10
    booking = add_minutes(F.to_timestamp(F.lit(BOOKING_START)),
                          ((F.col("l_orderkey") * 37) % BOOKING_SPAN_MIN).cast("int"))
    return vs.withColumns({
        "order_id": F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")),
        "customer_id": F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")),
        "carrier_name": carrier,
        "shipment_type": F.when(m8 <= 1, "Express").when(m8 <= 5, "Standard").otherwise("Economy"),
        "delay_profile": F.when(m10 <= 6, "normal").when(m10 <= 8, "minor").otherwise("major"),
        "weight_kg": F.round(F.lit(0.1) + (F.col("o_custkey") % 2990) / F.lit(100.0), 2),
        "booking_timestamp": booking,
    })


def visit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with the customer of their order (one row per line item of an order that is there): numbers and the id.

    The single shuffle of the line items (by shipment_id) happens here; shipments
    and scans are both projections of this frame.
    """
    v = visits(read_table(spark, sf_dir, "lineitem"))
    o = read_table(spark, sf_dir, "orders").select(_sid("o_orderkey").alias("shipment_id"), "o_custkey")
    return v.join(o, "shipment_id", "inner")


def _with_city(vs: DataFrame, index: str, out: str) -> DataFrame:
    """Add the name of the city with the number in ``index``."""
    names = R.bounded_broadcast(R.cities(vs.sparkSession).select(F.col("city_ix").alias("_ix"), F.col("city").alias(out)))
    return vs.join(names, F.col(index) == F.col("_ix"), "left").drop("_ix")


def shipments_from_visits(vs: DataFrame, distances: DataFrame) -> DataFrame:
    """One shipment per order: the first visit's row, with distance, zone, SLA, promise."""
    first = order_attributes(vs.filter(F.col("seq") == 1))
    ship = _with_city(_with_city(first, "origin_ix", "origin_hub"), "dest_ix", "destination_hub").select(
        "shipment_id", "order_id", "customer_id", "carrier_name", "shipment_type",
        "origin_hub", "destination_hub", "weight_kg", "booking_timestamp")
    ship = with_road_distance(ship, distances, "origin_hub", "destination_hub", "distance_km")
    return with_zone_sla(ship).select(
        "shipment_id", "order_id", "customer_id", "carrier_name", "shipment_type",
        "origin_hub", "destination_hub", "distance_km", "zone", "weight_kg",
        "booking_timestamp", "sla_hours", "expected_delivery_ts")


def scans_from_visits(vs: DataFrame, with_duplicates: bool = False) -> DataFrame:
    """Two scans per visit (arrival, departure); optionally some orders landed twice."""
    evt = F.concat(F.lit("EVT-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                   F.col("seq").cast("string"))
    arrival = F.struct(
        F.concat(evt, F.lit("A")).alias("event_id"),
        F.when(F.col("seq") == 1, K.PICKED_UP).otherwise(K.ARRIVED).alias("scan_type"),
        add_minutes("booking_timestamp", (F.col("base_min") + F.col("am")).cast("int")).alias("scan_timestamp"),
    )
    departure = F.struct(
        F.concat(evt, F.lit("D")).alias("event_id"),
        F.when(F.col("seq") == F.col("n"), K.DELIVERED).otherwise(K.DEPARTED).alias("scan_type"),
        add_minutes("booking_timestamp",
                    (F.col("base_min") + F.col("dwell_h") * 60 + F.col("dm")).cast("int")).alias("scan_timestamp"),
    )
    if with_duplicates:
        # orders landed twice: their scans appear a second time, verbatim
        copies = F.when(F.col("l_orderkey") % DUPLICATE_EVERY == 0, F.lit(2)).otherwise(F.lit(1))
        scans_arr = F.flatten(F.array_repeat(F.array(arrival, departure), copies))
    else:
        scans_arr = F.array(arrival, departure)
    vo = with_hub_id(_with_city(order_attributes(vs), "city_ix", "hub_name"), R.hub_master(vs.sparkSession), "hub_name", "hub_id")
    return (vo.select("shipment_id", "hub_name", "hub_id", "delay_profile", F.inline(scans_arr))
              .select("event_id", "shipment_id", "hub_name", "hub_id", "scan_type",
                      "scan_timestamp", F.lit("SUCCESS").alias("scan_status"), "delay_profile"))


def build(spark: SparkSession, sf_dir: str, with_duplicates: bool = False,
          visit_frame: DataFrame | None = None) -> Fixture:
    """Shipments and scan events for one scale-factor folder.

    ``visit_frame`` may be a stored copy of :func:`visit_rows` (see
    plans.layers.bronze_from_tables); by default it is derived lazily.
    """
    vs = visit_frame if visit_frame is not None else visit_rows(spark, sf_dir)
    distances = R.city_distances(spark)
    return Fixture(shipments_from_visits(vs, distances), scans_from_visits(vs, with_duplicates),
                   R.hub_master(spark), R.cities(spark), distances)
