"""Silver layer: shipments x scans, hub stays, dwell time, delay category.

Physical shape (one shuffle of the fact tables): shipments and scans are
clustered by ``shipment_id`` for the join; the lead window reuses that
clustering (only a sort is added); the stay filter sits above the window
because it reads lead(); the hub dimension is joined by broadcast, which
keeps the clustering for the gold windows that follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens import constants as K
from transitlens.functions.classify import delay_category, is_stay_pair
from transitlens.functions.numeric import ratio2
from transitlens.functions.temporal import parse_ts, seconds_between
from transitlens.operators.dedup import dedup
from transitlens.sources.reference import bounded_broadcast, estimated_bytes

SHIPMENT_COLUMNS = [
    "shipment_id", "order_id", "customer_id", "carrier_name", "shipment_type",
    "origin_hub", "destination_hub", "distance_km", "zone", "weight_kg",
    "booking_timestamp", "sla_hours", "expected_delivery_ts",
]
SCAN_COLUMNS = [
    "delay_profile", "event_id", "hub_name", "scan_status", "scan_timestamp", "scan_type", "hub_id",
]
# Hot ids up to this size (each brings one shipment row) are joined by broadcast.
MAX_HOT_BYTES = 1024 * 1024
# The joined projection (shipment attributes + scan attributes).
JOINED_COLUMNS = SHIPMENT_COLUMNS + SCAN_COLUMNS


def _as_ts(df: DataFrame, col: str) -> DataFrame:
    if col in df.columns and isinstance(df.schema[col].dataType, T.StringType):
        return df.withColumn(col, parse_ts(col))
    return df


def shipment_scans(shipments: DataFrame, scans: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """J1 + P3: inner join on shipment_id, 20-column projection, typed timestamps.

    One shipment row per id takes part (colliding ids: the smallest remaining
    columns, unless :func:`~transitlens.operators.dedup.dedup_shipments` chose
    before), so a collision does not pair a scan with its own copy. The
    aggregation uses the join's own clustering.

    With ``hot`` (a frame of hot shipment ids, see operators.skew) the scans
    of those ids join their shipment rows by broadcast instead of through the
    shuffle, if the list of ids is small: there is one shipment row per id.
    """
    from transitlens.operators.dedup import dedup_shipments
    from transitlens.operators.skew import split_hot

    s = _as_ts(scans, "scan_timestamp")
    sh = _as_ts(_as_ts(shipments, "booking_timestamp"), "expected_delivery_ts")
    sh = dedup_shipments(sh.select(*SHIPMENT_COLUMNS))
    size = None if hot is None else estimated_bytes(hot)
    if size is None or size > MAX_HOT_BYTES:
        return sh.join(s, "shipment_id", "inner").select(*JOINED_COLUMNS)
    sh_norm, sh_hot = split_hot(sh, hot, "shipment_id")
    s_norm, s_hot = split_hot(s, hot, "shipment_id")
    normal = sh_norm.join(s_norm, "shipment_id", "inner").select(*JOINED_COLUMNS)
    hot_part = s_hot.join(F.broadcast(sh_hot), "shipment_id", "inner").select(*JOINED_COLUMNS)
    return normal.unionByName(hot_part)


def with_next_scan(df: DataFrame, hot: DataFrame | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """Next scan type/time, dwell seconds and hours, scan date and hour."""
    from transitlens.operators.skew import with_neighbors

    leads = {"next_scan_type": "scan_type", "next_scan_timestamp": "scan_timestamp"}
    return (with_neighbors(df, "shipment_id", ["scan_timestamp", "event_id"], leads, {}, hot,
                           bucket_seconds=bucket_seconds)
            .withColumns({
                "duration_seconds": seconds_between("scan_timestamp", "next_scan_timestamp"),
                "timestamp_hour": F.hour("scan_timestamp"),
                "timestamp_date": F.to_date("scan_timestamp"),
            })
            .withColumn("dwell_hours", F.col("duration_seconds") / F.lit(3600.0)))


def hub_stays(df: DataFrame) -> DataFrame:
    """L1: keep (PICKED_UP|ARRIVED -> DEPARTED) and (ARRIVED -> DELIVERED) pairs."""
    return df.filter(is_stay_pair("scan_type", "next_scan_type"))


def hub_dim(hubs: DataFrame) -> DataFrame:
    """(primary_hub, hub_id, expected_dwell_hrs) from the hub master."""
    return hubs.select(F.col("hub_name").alias("primary_hub"), "hub_id",
                       F.col("expected_dwell_hrs").cast("int").alias("expected_dwell_hrs"))


def hub_versions(hubs: DataFrame, landed: str = "ingest_date", newest_by: str = "file_modification_time") -> DataFrame:
    """The hub masters of all landing dates as versions: one row per hub and date, valid from that date to the next.

    Of several rows of a hub in a landing the newest file's counts. The first
    version also holds for all time before it.
    """
    one = dedup(hubs.filter(F.col("hub_id").isNotNull()), ["hub_id", landed], newest_by)
    w = Window.partitionBy("hub_id").orderBy(landed)
    return one.withColumns({
        "valid_from": F.when(F.lag(landed).over(w).isNull(), F.lit("0001-01-01").cast("date")).otherwise(F.col(landed)),
        "valid_to": F.coalesce(F.lead(landed).over(w), F.lit("9999-12-31").cast("date"))})


def with_expected_dwell(stays: DataFrame, hubs: DataFrame) -> DataFrame:
    """J2 + P7: left join on hub_id; no hub (or NULL hub_id) -> expected dwell 0.

    With versions (see :func:`hub_versions`) a stay takes the one that is valid
    on its scan date, so that a later hub master leaves earlier stays alone; a
    stay without a date takes the first.
    """
    if "valid_from" in hubs.columns:
        dim = hubs.select(F.col("hub_name").alias("primary_hub"), F.col("hub_id").alias("_hub"),
                          F.col("expected_dwell_hrs").cast("int").alias("expected_dwell_hrs"), "valid_from", "valid_to")
        day = F.coalesce("timestamp_date", F.lit("0001-01-01").cast("date"))
        on = (F.col("hub_id") == F.col("_hub")) & (day >= F.col("valid_from")) & (day < F.col("valid_to"))
        return (stays.join(bounded_broadcast(dim), on, "left").drop("_hub", "valid_from", "valid_to")
                     .withColumn("expected_dwell_hrs", F.coalesce("expected_dwell_hrs", F.lit(0))))
    return (stays.join(bounded_broadcast(hub_dim(hubs)), "hub_id", "left")
                 .withColumn("expected_dwell_hrs", F.coalesce("expected_dwell_hrs", F.lit(0))))


def with_delay(df: DataFrame) -> DataFrame:
    """P8 + C1: delay_hrs = dwell - expected (may be negative), delay_category.

    ``delay_seconds`` is the same quantity in whole seconds; rollups sum it
    exactly instead of summing doubles.
    """
    return (df.withColumn("delay_seconds",
                          F.col("duration_seconds") - F.col("expected_dwell_hrs").cast("bigint") * 3600)
              .withColumn("delay_hrs", F.col("dwell_hours") - F.col("expected_dwell_hrs"))
              .withColumn("delay_category", delay_category("delay_hrs")))


def silver_stays(shipments: DataFrame, scans: DataFrame, hubs: DataFrame,
                 hot: DataFrame | None = None) -> DataFrame:
    """The whole silver chain, one row per hub stay."""
    joined = shipment_scans(shipments, scans, hot)
    return with_delay(with_expected_dwell(hub_stays(with_next_scan(joined, hot)), hubs))


def hub_day_silver(stays: DataFrame) -> DataFrame:
    """A1 + A2: per (hub_name, date) stays, delayed stays (> 1 h), delay hours, average.

    The average is 0 when nothing is delayed (silver rule; gold gives NULL).
    """
    over_sec = K.NORMAL_MAX_HRS * 3600
    delayed = F.col("delay_seconds") > over_sec
    keys, counts = ["hub_name", "timestamp_date"], ["total_shipments_of_day", "delayed_shipments_of_day", "_delay_sec"]
    # the smallest text of a group would sort all stays: hub ids are a key of the sums first, the few sums are sorted
    by_id = (stays.groupBy(*keys, "hub_id")
                  .agg(F.count("shipment_id").alias("total_shipments_of_day"),
                       F.count(F.when(F.col("delay_category").isin(K.MINOR_DELAY, K.MAJOR_DELAY), True))
                        .alias("delayed_shipments_of_day"),
                       F.sum(F.when(delayed, F.col("delay_seconds")).otherwise(F.lit(0)))
                        .alias("_delay_sec")))
    agg = by_id.groupBy(*keys).agg(F.min("hub_id").alias("hub_id"), *[F.sum(c).alias(c) for c in counts])
    return (agg.withColumn("total_delay_hours_of_day", F.col("_delay_sec") / F.lit(3600.0))
               .withColumn("avg_delay_hours_of_day",
                           F.when(F.col("delayed_shipments_of_day") != 0,
                                  ratio2("_delay_sec", "delayed_shipments_of_day", 3600))
                            .otherwise(F.lit(0.0)))
               .drop("_delay_sec"))
