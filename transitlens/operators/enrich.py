"""Shipment enrichment: distances, zone, SLA hours, promised delivery, hub ids.

Distances come from a (from_city, to_city, road_km) table joined by
broadcast on both keys; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens import constants as K
from transitlens.functions.classify import sla_hours, zone
from transitlens.functions.geo import with_road_km
from transitlens.functions.temporal import add_hours
from transitlens.sources.reference import bounded_broadcast


def with_road_distance(df: DataFrame, distances: DataFrame, from_col: str, to_col: str,
                       out_col: str = "distance_km", null_from_is_zero: bool = False) -> DataFrame:
    """Add ``out_col`` = road km between the cities in ``from_col`` and ``to_col``.

    ``distances`` is a (from_city, to_city, road_km) table (see
    ``reference.city_distances`` / ``route_distances``); it is broadcast when
    its size allows. Same city -> 0. With ``null_from_is_zero`` a NULL origin
    also gives 0 (first hop of a journey). Unknown pairs give NULL.
    """
    lk = distances.select(F.col("from_city").alias("_rd_from"), F.col("to_city").alias("_rd_to"),
                          F.col("road_km").alias("_rd_km"))
    cond = (F.col(from_col) == F.col("_rd_from")) & (F.col(to_col) == F.col("_rd_to"))
    j = df.join(bounded_broadcast(lk), cond, "left")
    dist = F.when(F.col(from_col) == F.col(to_col), F.lit(0.0))
    if null_from_is_zero:
        dist = dist.when(F.col(from_col).isNull(), F.lit(0.0))
    dist = dist.otherwise(F.col("_rd_km"))
    return j.withColumn(out_col, dist).drop("_rd_from", "_rd_to", "_rd_km")


def route_distances(pairs: DataFrame, cities: DataFrame, from_col: str = "from_city",
                    to_col: str = "to_city", road_factor: float = K.ROAD_FACTOR) -> DataFrame:
    """Road km for the distinct (from, to) city pairs found in ``pairs``.

    For city lists other than the reference one: derive the pairs actually
    travelled from the data (partial-aggregated distinct, at most cities^2
    rows), look up both ends' coordinates and evaluate the geodesic once per
    pair. The result feeds :func:`with_road_distance`.
    """
    p = pairs.select(F.col(from_col).alias("from_city"), F.col(to_col).alias("to_city")).distinct()
    a = cities.select(F.col("city").alias("from_city"), F.col("lat").alias("from_lat"),
                      F.col("lon").alias("from_lon"))
    b = cities.select(F.col("city").alias("to_city"), F.col("lat").alias("to_lat"),
                      F.col("lon").alias("to_lon"))
    j = p.join(bounded_broadcast(a), "from_city", "inner").join(bounded_broadcast(b), "to_city", "inner")
    return with_road_km(j, "from_lat", "from_lon", "to_lat", "to_lon", "road_km", road_factor) \
        .select("from_city", "to_city", "road_km")


def with_zone_sla(df: DataFrame, distance_col: str = "distance_km",
                  type_col: str = "shipment_type", booking_col: str = "booking_timestamp") -> DataFrame:
    """zone (C4), sla_hours (C5, rate card) and expected_delivery_ts."""
    return (df.withColumn("zone", zone(distance_col))
              .withColumn("sla_hours", sla_hours("zone", type_col))
              .withColumn("expected_delivery_ts", add_hours(booking_col, "sla_hours")))


def with_sla_from_card(df: DataFrame, card: DataFrame, zone_col: str = "zone",
                       type_col: str = "shipment_type") -> DataFrame:
    """C5 as a lookup: broadcast left join to a (zone, shipment_type, sla_hours) card.

    An unknown (zone, type) pair keeps the row with NULL hours and
    ``sla_unknown`` = true instead of failing (the reference raises).
    The CASE form in ``with_zone_sla`` gives the same hours for the fixed card.
    """
    lk = card.select(F.col("zone").alias("_card_zone"), F.col("shipment_type").alias("_card_type"),
                     F.col("sla_hours").alias("_card_hours"))
    cond = (F.col(zone_col) == F.col("_card_zone")) & (F.col(type_col) == F.col("_card_type"))
    return (df.join(bounded_broadcast(lk), cond, "left")
              .withColumn("sla_hours", F.col("_card_hours"))
              .withColumn("sla_unknown", F.col("_card_hours").isNull())
              .drop("_card_zone", "_card_type", "_card_hours"))


def with_hub_id(df: DataFrame, hubs: DataFrame, city_col: str = "hub_name",
                out_col: str = "hub_id") -> DataFrame:
    """City -> hub_id via the hub master; cities without a hub get NULL."""
    lk = hubs.select(F.col("city").alias("_hub_city"), F.col("hub_id").alias(out_col))
    return (df.join(bounded_broadcast(lk), F.col(city_col) == F.col("_hub_city"), "left")
              .drop("_hub_city"))
