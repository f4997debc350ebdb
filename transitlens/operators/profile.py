"""Descriptive rollups over shipments and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.operators.skew import with_sequence


def shipment_profile(shipments: DataFrame) -> DataFrame:
    """Shipment counts by zone, by type and by carrier, plus the total.

    One pass: each shipment is unpivoted into four (dimension, value) rows
    and counted with a single partial + final aggregation.
    """
    pairs = F.expr(
        "stack(4, 'zone', zone, 'shipment_type', shipment_type, "
        "'carrier_name', carrier_name, 'total', 'all') as (dimension, value)")
    return (shipments.select(pairs)
                     .groupBy("dimension", "value")
                     .agg(F.count(F.lit(1)).alias("shipments")))


def scan_sequence(scans: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """1-based position of every scan inside its shipment's journey."""
    return with_sequence(scans, "shipment_id", ["scan_timestamp", "event_id"], "scan_seq", hot)


def time_range(df: DataFrame, col: str) -> DataFrame:
    """Earliest and latest value and the row count, in one partial-aggregated pass."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"),
                  F.count(F.lit(1)).alias("rows"))
