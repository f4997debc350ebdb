"""Named queries over a scale-factor folder: one per operator family.

Every query derives shipments and scans from the folder's ``orders`` and
``lineitem`` tables (sources.fixtures) and runs the library operators over
the whole of them. Temporal output columns are rendered as text so results
compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.operators import dark as D
from transitlens.operators import delay as G
from transitlens.operators import sla as S
from transitlens.operators.dedup import dedup_scans
from transitlens.operators.profile import scan_sequence, shipment_profile
from transitlens.operators.silver import hub_day_silver, shipment_scans as _join
from transitlens.plans.layers import as_text, bronze_from_tables, dark_from_tables, silver_from_tables
from transitlens.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def q_shipment_zone_sla(spark, sf_dir):
    """Shipments with distance, zone, SLA and promise."""
    return as_text(bronze_from_tables(spark, sf_dir).shipments)


def q_shipment_profile(spark, sf_dir):
    """Counts by zone, type, carrier and the total."""
    return shipment_profile(bronze_from_tables(spark, sf_dir).shipments)


def q_shipment_scans(spark, sf_dir):
    """Every scan with its shipment's attributes."""
    fx = bronze_from_tables(spark, sf_dir)
    return as_text(_join(fx.shipments, fx.scans))


def q_hub_stays(spark, sf_dir):
    """Hub stays with next scan and dwell."""
    s = silver_from_tables(spark, sf_dir).stays
    return as_text(s.select("shipment_id", "event_id", "hub_name", "hub_id", "scan_type",
                            "scan_timestamp", "next_scan_type", "next_scan_timestamp",
                            "duration_seconds", "dwell_hours", "timestamp_date", "timestamp_hour"))


def q_stay_delays(spark, sf_dir):
    """Expected dwell, delay hours and delay category per stay."""
    s = silver_from_tables(spark, sf_dir).stays
    return s.select("shipment_id", "event_id", "hub_name", "hub_id", "primary_hub",
                    "expected_dwell_hrs", "dwell_hours", "delay_hrs", "delay_category")


def q_hub_day_silver(spark, sf_dir):
    """A1, A2: silver hub-day rollup."""
    return as_text(hub_day_silver(silver_from_tables(spark, sf_dir).stays))


def q_hub_day_gold(spark, sf_dir):
    """Gold hub-day rollup."""
    return as_text(G.hub_day_gold(silver_from_tables(spark, sf_dir).stays))


def q_total_time_by_hub(spark, sf_dir):
    """Hub-day rollup with bottleneck score and day name."""
    return as_text(G.total_time_by_hub(silver_from_tables(spark, sf_dir).stays))


def _dark(spark, sf_dir, leg="inbound"):
    return dark_from_tables(spark, sf_dir, leg)


def q_dark_periods(spark, sf_dir):
    """Per-stay visibility label."""
    return _dark(spark, sf_dir).select(
        "shipment_id", "event_id", "hub_name", "prev_hub", "hop_distance_km",
        "expected_travel_hrs", "actual_total_time", "extra_hrs", "visibility_status")


def q_worst_routes(spark, sf_dir):
    """Dark periods per route, most first."""
    return D.worst_routes(_dark(spark, sf_dir))


def q_dark_rate_by_hub(spark, sf_dir):
    """Dark-period share of stays per hub."""
    return D.dark_rate_by_hub(_dark(spark, sf_dir))


def q_visibility_summary(spark, sf_dir):
    """C2 totals: stays and gap hours per visibility label (inbound hop)."""
    return D.visibility_summary(_dark(spark, sf_dir))


def q_visibility_summary_outbound(spark, sf_dir):
    """C2 with leg='outbound': hop measured towards the next hub."""
    return D.visibility_summary(_dark(spark, sf_dir, leg="outbound"))


def _sla(spark, sf_dir):
    return S.sla_status(silver_from_tables(spark, sf_dir).stays)


def q_sla_status(spark, sf_dir):
    """SLA label per delivered shipment."""
    return as_text(_sla(spark, sf_dir).select(
        "shipment_id", "expected_delivery_ts", "next_scan_type", "next_scan_timestamp", "delivery_sla"))


def q_sla_breach_by_zone(spark, sf_dir):
    """A6, L3."""
    return S.sla_breach_by_zone(_sla(spark, sf_dir))


def q_sla_breach_by_carrier(spark, sf_dir):
    """A7, L3."""
    return S.sla_breach_by_carrier(_sla(spark, sf_dir))


def q_sla_status_by_zone(spark, sf_dir):
    """C3 by zone: deliveries per (zone, label)."""
    return S.sla_status_by_zone(_sla(spark, sf_dir))


def q_sla_share(spark, sf_dir):
    """Overall share per label."""
    return S.sla_share(_sla(spark, sf_dir))


def q_carrier_delay(spark, sf_dir):
    """Per-carrier measures, score and rank (reference grain)."""
    return G.carrier_delay(silver_from_tables(spark, sf_dir).stays)


def q_carrier_delay_daily(spark, sf_dir):
    """A5 at the per-day grain: carriers ranked within each date."""
    return as_text(G.carrier_delay(silver_from_tables(spark, sf_dir).stays, grain="daily"))


def q_worst_carrier(spark, sf_dir):
    """O2: the single worst carrier."""
    return G.worst_carrier(silver_from_tables(spark, sf_dir).stays)


def _by_hub(spark, sf_dir):
    return G.total_time_by_hub(silver_from_tables(spark, sf_dir).stays)


def q_worst_day_each_hub(spark, sf_dir):
    """Worst date per hub (NULL scores last)."""
    return as_text(G.worst_day_each_hub(_by_hub(spark, sf_dir)))


def q_worst_day_each_hub_nulls_first(spark, sf_dir):
    """Same with the warehouse's NULLs-first DESC order."""
    return as_text(G.worst_day_each_hub(_by_hub(spark, sf_dir), null_scores="first"))


def q_worst_weekday_each_hub(spark, sf_dir):
    """A9 at grain='weekday': worst day of the week per hub."""
    return G.worst_day_each_hub(_by_hub(spark, sf_dir), grain="weekday")


def q_worst_hub_days_top5(spark, sf_dir):
    """Top 5 hub-days by bottleneck score."""
    return as_text(G.worst_hub_days(_by_hub(spark, sf_dir), 5))


def q_hub_bottleneck_ranking(spark, sf_dir):
    """A10: hub ranking by average dwell over expected."""
    return G.hub_bottleneck_ranking(silver_from_tables(spark, sf_dir).stays)


def q_dedup_scans(spark, sf_dir):
    """scans landed twice for some orders, de-duplicated."""
    fx = bronze_from_tables(spark, sf_dir, with_duplicates=True)
    return as_text(dedup_scans(fx.scans))


def q_silver_dedup_counts(spark, sf_dir):
    """F1 inside the silver build: duplicated landing, same stays as a clean one."""
    sv = silver_from_tables(spark, sf_dir, dedupe=True, with_duplicates=True)
    return sv.stays.groupBy("delay_category").agg(F.count(F.lit(1)).alias("stays"))


def q_scan_sequence(spark, sf_dir):
    """Scan position within each shipment."""
    fx = bronze_from_tables(spark, sf_dir)
    return scan_sequence(fx.scans).select("shipment_id", "event_id", "scan_type", "scan_seq")


def q_hub_distances(spark, sf_dir):
    """Road distance of every distinct hub-to-hub hop travelled."""
    d = _dark(spark, sf_dir).filter(F.col("prev_hub").isNotNull())
    return (d.select(F.col("prev_hub").alias("from_city"), F.col("hub_name").alias("to_city"),
                     F.col("hop_distance_km").alias("road_km"))
             .distinct())


def q_daily_run_worst_routes(spark, sf_dir):
    """S1-S10, P1, F1 end to end: raw CSV/JSON files -> bronze -> silver -> gold.

    The derived shipments, hubs and scans are first landed as raw text files
    (once per input version, in the checkpoint folder); the daily run then
    reads only those files and the published gold table is returned.
    """
    from transitlens.plans import daily, store
    from transitlens.session import checkpoint_dir

    base = sf_dir.rstrip("/")
    key = store.fingerprint(spark, [f"{base}/lineitem.parquet", f"{base}/orders.parquet"], "daily-v1")
    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/{store.namespace(spark)}/daily/{key}"
    gold = f"{root}/lake/gold/worst_routes"
    fs, p = store._fs(spark, gold + "/_SUCCESS")
    if not fs.exists(p):
        fx = bronze_from_tables(spark, sf_dir)
        raw = f"{root}/raw"
        as_text(fx.shipments).write.mode("overwrite").options(header="true", compression="gzip").csv(f"{raw}/shipment_master")
        fx.hubs.write.mode("overwrite").option("header", "true").csv(f"{raw}/hub_master")
        as_text(fx.scans).write.mode("overwrite").option("compression", "gzip").json(f"{raw}/checkpoint_scan_events")
        daily.run_daily(spark, raw, f"{root}/lake", "2026-05-02")
    return spark.read.parquet(gold)


def q_worst_routes_hot_split(spark, sf_dir):
    """A8 through the hot-key path: the 50 longest journeys are windowed per
    (id, hour bucket) and stitched (operators.skew); result equals worst_routes."""
    from transitlens.operators.skew import detect_hot_keys, hot_key_frame

    # counted once, for the silver build and the dark periods
    keys = detect_hot_keys(bronze_from_tables(spark, sf_dir).scans, "shipment_id", fraction=1.0, top=50)
    sv = silver_from_tables(spark, sf_dir, hot_top=50, hot_keys=keys)
    hot = hot_key_frame(spark, "shipment_id", keys)
    return D.worst_routes(D.dark_periods(sv.stays, sv.distances, hot=hot))


def q_scan_time_range(spark, sf_dir):
    """Earliest and latest scan over all scan events."""
    from transitlens.operators.profile import time_range

    return as_text(time_range(bronze_from_tables(spark, sf_dir).scans, "scan_timestamp"))


def q_longest_dark_periods(spark, sf_dir):
    """Top 20 dark periods by extra hours (a top-k report)."""
    return D.longest_dark_periods(_dark(spark, sf_dir), 20).select(
        "shipment_id", "event_id", "hub_name", "prev_hub", "actual_total_time", "expected_travel_hrs", "extra_hrs")


def q_dark_periods_by_extra_hours(spark, sf_dir):
    """All dark periods by extra hours."""
    return D.longest_dark_periods(_dark(spark, sf_dir)).select(
        "shipment_id", "event_id", "hub_name", "prev_hub", "actual_total_time", "expected_travel_hrs", "extra_hrs")


def q_shipments_by_zone(spark, sf_dir):
    """Shipments per zone, sorted by zone."""
    from transitlens.operators.ranking import top

    ship = bronze_from_tables(spark, sf_dir).shipments
    return top(ship.groupBy("zone").agg(F.count(F.lit(1)).alias("shipments")), ["zone"])


def _order_key(col="shipment_id"):
    return F.substring(col, 5, 20).cast("bigint")


def _two_landings(spark, sf_dir):
    """A lake fed by two daily runs, whose landings share journeys.

    Day one lands every other shipment and the scans of odd and even events
    apart, so journeys straddle the days. Day two lands the rest, some rows of
    day one again, columns in another order (CSV), keys in capitals (JSON),
    and broken copies of the scans of every fiftieth order.
    """
    from transitlens.plans import daily, store
    from transitlens.session import checkpoint_dir

    base = sf_dir.rstrip("/")
    key = store.fingerprint(spark, [f"{base}/lineitem.parquet", f"{base}/orders.parquet"], "two-landings")
    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/{store.namespace(spark)}/landings/{key}"
    lake = f"{root}/lake"
    fs, p = store._fs(spark, f"{root}/done/_SUCCESS")
    if not fs.exists(p):
        fx = bronze_from_tables(spark, sf_dir)
        ships, scans, n = as_text(fx.shipments), as_text(fx.scans), _order_key()
        arrival = F.col("event_id").endswith("A")
        days = {
            "2026-05-01": (ships.filter(n % 2 == 0), scans.filter(arrival), lambda c: c),
            "2026-05-02": (ships.filter((n % 2 == 1) | (n % 10 == 0)).select(*sorted(ships.columns)),
                           scans.filter(~arrival | (n % 7 == 0)).unionByName(
                               scans.filter(n % 50 == 0).withColumn("scan_timestamp", F.lit("no time"))), str.upper),
        }
        for ds, (ship, scan, case) in days.items():
            raw = f"{root}/raw/{ds}"
            ship.write.mode("overwrite").options(header="true", compression="gzip").csv(f"{raw}/shipment_master")
            fx.hubs.write.mode("overwrite").option("header", "true").csv(f"{raw}/hub_master")
            scan.toDF(*[case(c) for c in scan.columns]).write.mode("overwrite").option("compression", "gzip").json(f"{raw}/checkpoint_scan_events")
            daily.run_daily(spark, f"{root}/raw", lake, ds)
        spark.range(1).write.mode("overwrite").parquet(f"{root}/done")
    return lake


def q_daily_run_two_landings(spark, sf_dir):
    """Worst routes after two daily runs equal those of one landing."""
    return spark.read.parquet(f"{_two_landings(spark, sf_dir)}/gold/worst_routes")


def q_daily_run_rejects(spark, sf_dir):
    """Quarantined rows of the second landing by dataset and reason."""
    from transitlens.sources.files import listed

    root, out = f"{_two_landings(spark, sf_dir)}/quarantine", None
    for name in ("shipment_master", "hub_master", "checkpoint_scan_events"):
        if listed(spark, f"{root}/{name}"):
            one = spark.read.parquet(f"{root}/{name}").filter("ingest_date = date'2026-05-02'") \
                .groupBy(F.lit(name).alias("dataset"), F.col("_reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("rejected"))
            out = one if out is None else out.union(one)
    return out if out is not None else spark.createDataFrame([], "dataset string, reason string, rejected long")


def q_incremental_load_counts(spark, sf_dir):
    """Rows that each run of the file intake loads: a third of the scans, the rest, nothing new."""
    import uuid

    from transitlens import schemas
    from transitlens.session import checkpoint_dir
    from transitlens.streaming.ingest import ingest_incremental

    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/incremental/{uuid.uuid4().hex}"
    scans, n = bronze_from_tables(spark, sf_dir).scans, _order_key()
    out = []
    for run, part in enumerate((scans.filter(n % 3 == 0), scans.filter(n % 3 != 0), None), 1):
        if part is not None:
            part.write.parquet(f"{root}/source/{run}")
        got = ingest_incremental(spark, f"{root}/source", f"{root}/target", f"{root}/checkpoint", schemas.SCAN_EVENTS)
        out.append((run, got["rows"]))
    return spark.createDataFrame(out, "run int, loaded long")


def q_intake_worst_routes(spark, sf_dir):
    """Worst routes of a lake that file streams feed: shipments, then arrivals, then departures as JSON.

    Every batch rebuilds the journeys it names, so the last state equals that
    of one daily run over all files.
    """
    import uuid

    from transitlens.plans import daily
    from transitlens.session import checkpoint_dir
    from transitlens.streaming.ingest import feed_lake

    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/fed/{uuid.uuid4().hex}"
    fx = bronze_from_tables(spark, sf_dir)
    hubs = fx.hubs.withColumn("file_modification_time", F.lit("2026-05-01 00:00:00").cast("timestamp"))
    daily.land_rows(spark, hubs, f"{root}/lake", "hub_master", "2026-05-01")
    scans, arrival = as_text(fx.scans), F.col("event_id").endswith("A")
    as_text(fx.shipments).write.parquet(f"{root}/in/shipment_master")
    feed_lake(spark, f"{root}/in/shipment_master", f"{root}/lake", "shipment_master", f"{root}/ck/shipments")
    for part, rows in enumerate((scans.filter(arrival), scans.filter(~arrival))):
        rows.write.option("compression", "gzip").json(f"{root}/in/scans/{part}")
        feed_lake(spark, f"{root}/in/scans", f"{root}/lake", "checkpoint_scan_events", f"{root}/ck/scans", "json", "*.json*")
    return spark.read.parquet(f"{root}/lake/gold/worst_routes")


def q_json_layouts(spark, sf_dir):
    """Rows and broken records of JSON landings in three layouts: lines, array elements, pretty-printed objects."""
    import uuid

    from transitlens import schemas
    from transitlens.session import checkpoint_dir
    from transitlens.sources.readers import enforce_schema, read_raw

    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/layouts/{uuid.uuid4().hex}"
    scans, n = bronze_from_tables(spark, sf_dir).scans, _order_key()
    record = F.to_json(F.struct(*scans.columns))
    pretty = F.regexp_replace(F.regexp_replace(record, r',"', ',\n  "'), r"\}$", "\n}")
    out = None
    for k, (layout, text) in enumerate({"lines": record, "elements": F.concat(record, F.lit(",")), "pretty": pretty}.items()):
        own = as_text(scans).filter(n % 3 == k).withColumn("value", text)
        # a copy of every fiftieth order without the end of its last value
        broken = own.filter(n % 50 == 0).withColumn("value", F.regexp_replace("value", r'"\s*\},?$', "}"))
        own.unionByName(broken).select("value").write.option("compression", "gzip").text(f"{root}/{layout}")
        typed = enforce_schema(read_raw(spark, f"{root}/{layout}", "json", schemas.SCAN_EVENTS), schemas.SCAN_EVENTS)
        one = typed.groupBy(F.lit(layout).alias("layout")).agg(
            F.count(F.when(~F.col("_rejected"), True)).alias("loaded"), F.count(F.when(F.col("_rejected"), True)).alias("rejected"))
        out = one if out is None else out.unionByName(one)
    return out


def q_published_views(spark, sf_dir):
    """The worst-carrier view that a daily run publishes, over gold merged from two landings."""
    from transitlens.plans.layers import persist_views

    persist_views(spark, f"{_two_landings(spark, sf_dir)}/gold", "transitlens_gold")
    return spark.table("transitlens_gold.worst_carrier")


def q_late_files_worst_routes(spark, sf_dir):
    """Worst routes of a lake whose runs load what the file ledger hasn't seen.

    The first day lacks the shipments and scans of every third order and the
    hub departures of every fifth; the files that hold them come a day later
    into the first day's folder, beside a second day's folder with copies.
    """
    import uuid

    from transitlens.plans import daily
    from transitlens.session import checkpoint_dir

    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/late/{uuid.uuid4().hex}"
    fx, n = bronze_from_tables(spark, sf_dir), _order_key()
    ships, scans = as_text(fx.shipments), as_text(fx.scans)
    late = (n % 3 == 0) | (n % 5 == 0) & F.col("event_id").endswith("D")

    def csv(df, name):
        df.write.mode("append").options(header="true", compression="gzip").csv(f"{root}/raw/{name}")

    def json(df, name):
        df.write.mode("append").option("compression", "gzip").json(f"{root}/raw/{name}")

    csv(fx.hubs, "2026-05-01/hub_master")
    csv(ships.filter(n % 3 != 0), "2026-05-01/shipment_master")
    json(scans.filter(~late), "2026-05-01/checkpoint_scan_events")
    daily.run_daily(spark, f"{root}/raw", f"{root}/lake", "2026-05-01", ledger=True)
    csv(ships.filter(n % 3 == 0), "2026-05-01/shipment_master")
    json(scans.filter(late), "2026-05-01/checkpoint_scan_events")
    json(scans.filter(n % 7 == 0), "2026-05-02/checkpoint_scan_events")
    daily.run_daily(spark, f"{root}/raw", f"{root}/lake", "2026-05-02", ledger=True)
    return spark.read.parquet(f"{root}/lake/gold/worst_routes")


def q_evolved_table(spark, sf_dir):
    """The gold rollup over a catalogued table whose older partitions lack total_time.

    Dates of odd days were written before the column came, with the delay
    under an older name, which a rename mends on landing; the others hold it.
    """
    import uuid

    from transitlens.operators.dedup import append_by_name
    from transitlens.session import checkpoint_dir
    from transitlens.sources.sinks import publish_partitions, rename_columns

    run = uuid.uuid4().hex
    path, name = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/evolved/{run}", f"transitlens_evolved_{run}"
    cols = ["hub_name", "shipment_id", "delay_profile", "delay_seconds", "timestamp_date"]
    stays = silver_from_tables(spark, sf_dir).stays
    odd = F.coalesce(F.dayofmonth("timestamp_date") % 2 == 1, F.lit(True))
    older = stays.filter(odd).select(*cols).withColumnRenamed("delay_seconds", "delay_secs")
    publish_partitions(rename_columns(older, {"delay_secs": "delay_seconds"}), name, path, "timestamp_date")
    table = publish_partitions(stays.filter(~odd).select(*cols[:-1], "total_time", "timestamp_date"), name, path, "timestamp_date")
    missing = F.col("total_time").isNull()
    filled = append_by_name(table.filter(~missing), G.with_total_time(table.filter(missing).drop("total_time")))
    return as_text(G.hub_day_gold(filled))


def q_one_hour_journey(spark, sf_dir):
    """All scans of the table as one journey within an hour, split at quantiles and stitched."""
    from transitlens.operators.skew import hot_key_frame, with_neighbors, with_segment, with_sequence

    second = F.pmod(_order_key() * 7919, F.lit(3600))
    scans = bronze_from_tables(spark, sf_dir).scans.select(
        F.lit("ALL").alias("journey"), "event_id", "scan_type",
        F.timestamp_seconds(F.lit(1_775_001_600) + second).alias("scan_timestamp"))
    hot = hot_key_frame(spark, "journey", ["ALL"])
    order = ["scan_timestamp", "event_id"]
    # one journey, so all rows are hot; both operators share its segments
    cut = with_segment(scans, "journey", order, "segment", segment_rows=10_000)
    joined = with_neighbors(cut, "journey", order, {"next_event_id": "event_id", "next_scan_type": "scan_type"},
                            {"prev_event_id": "event_id"}, hot, segment="segment")
    return as_text(with_sequence(joined, "journey", order, "scan_seq", hot, segment="segment").drop("journey", "segment"))


QUERIES: dict[str, Query] = {
    "shipment_zone_sla": q_shipment_zone_sla,
    "shipment_profile": q_shipment_profile,
    "shipment_scans": q_shipment_scans,
    "hub_stays": q_hub_stays,
    "stay_delays": q_stay_delays,
    "hub_day_silver": q_hub_day_silver,
    "hub_day_gold": q_hub_day_gold,
    "total_time_by_hub": q_total_time_by_hub,
    "dark_periods": q_dark_periods,
    "worst_routes": q_worst_routes,
    "dark_rate_by_hub": q_dark_rate_by_hub,
    "visibility_summary": q_visibility_summary,
    "visibility_summary_outbound": q_visibility_summary_outbound,
    "sla_status": q_sla_status,
    "sla_breach_by_zone": q_sla_breach_by_zone,
    "sla_breach_by_carrier": q_sla_breach_by_carrier,
    "sla_status_by_zone": q_sla_status_by_zone,
    "sla_share": q_sla_share,
    "carrier_delay": q_carrier_delay,
    "carrier_delay_daily": q_carrier_delay_daily,
    "worst_carrier": q_worst_carrier,
    "worst_day_each_hub": q_worst_day_each_hub,
    "worst_day_each_hub_nulls_first": q_worst_day_each_hub_nulls_first,
    "worst_weekday_each_hub": q_worst_weekday_each_hub,
    "worst_hub_days_top5": q_worst_hub_days_top5,
    "hub_bottleneck_ranking": q_hub_bottleneck_ranking,
    "dedup_scans": q_dedup_scans,
    "silver_dedup_counts": q_silver_dedup_counts,
    "scan_sequence": q_scan_sequence,
    "hub_distances": q_hub_distances,
    "daily_run_worst_routes": q_daily_run_worst_routes,
    "worst_routes_hot_split": q_worst_routes_hot_split,
    "scan_time_range": q_scan_time_range,
    "longest_dark_periods": q_longest_dark_periods,
    "dark_periods_by_extra_hours": q_dark_periods_by_extra_hours,
    "shipments_by_zone": q_shipments_by_zone,
    "daily_run_two_landings": q_daily_run_two_landings,
    "daily_run_rejects": q_daily_run_rejects,
    "incremental_load_counts": q_incremental_load_counts,
    "intake_worst_routes": q_intake_worst_routes,
    "json_layouts": q_json_layouts,
    "published_views": q_published_views,
    "late_files_worst_routes": q_late_files_worst_routes,
    "evolved_table": q_evolved_table,
    "one_hour_journey": q_one_hour_journey,
}
