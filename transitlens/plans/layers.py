"""End-to-end plans: silver build, gold frames, views, the daily run."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.operators import dark as D
from transitlens.operators import delay as G
from transitlens.operators import sla as S
from transitlens.operators.dedup import SCAN_KEYS, SHIPMENT_KEYS, dedup_scans, dedup_shipments
from transitlens.operators.silver import silver_stays
from transitlens.operators.skew import detect_hot_keys, hot_key_frame
from transitlens.plans import store
from transitlens.sources import fixtures
from transitlens.sources import reference as R


# Journeys' tables are stored in buckets of the journey, in the order of the windows over them.
CLUSTER = ("shipment_id", ["shipment_id", "scan_timestamp", "event_id"])


class Silver(NamedTuple):
    shipments: DataFrame | None   # None when the stays were read from the store
    scans: DataFrame | None
    stays: DataFrame   # silver wide table + total_time, one row per hub stay
    hubs: DataFrame
    distances: DataFrame   # (from_city, to_city, road_km)
    hot: DataFrame | None = None   # shipment ids whose journeys take the split path


def build_silver(shipments: DataFrame, scans: DataFrame, hubs: DataFrame, distances: DataFrame,
                 dedupe: bool = False, shipments_newest_by: str | None = None,
                 scans_newest_by: str | None = None, hot_keys: list | str | None = None) -> Silver:
    """Silver stays (J7) plus the gold TOTAL_TIME column.

    ``dedupe`` removes repeated scans and collapses colliding shipment ids
    (the newest by ``scans_newest_by`` and ``shipments_newest_by`` wins) before the join, so it cannot fan out.
    ``hot_keys`` lists shipment ids that hold a large share of the scans, or
    ``"auto"`` to detect them on a sample; their journeys take the split path
    of operators.skew instead of one task per id.
    """
    if dedupe:
        # what follows takes a journey in one task unless it is hot: without hot ones a shuffle by journey serves all
        scans = dedup_scans(scans, scans_newest_by, SCAN_KEYS if hot_keys else SHIPMENT_KEYS)
        shipments = dedup_shipments(shipments, shipments_newest_by)
    hot = None
    if hot_keys == "auto":
        hot_keys = detect_hot_keys(scans, "shipment_id")
    if hot_keys:
        hot = hot_key_frame(scans.sparkSession, "shipment_id", list(hot_keys))
    stays = G.with_total_time(silver_stays(shipments, scans, hubs, hot))
    return Silver(shipments, scans, stays, hubs, distances, hot)


def silver_from_tables(spark: SparkSession, sf_dir: str, dedupe: bool = False,
                       with_duplicates: bool = False, materialized: bool | None = None,
                       hot_top: int | None = None, hot_keys: list | None = None) -> Silver:
    """Silver over the shipments/scans derived from the star-schema tables.

    With materialization on (session conf ``spark.transitlens.materialize``,
    default true) the stays are written once per input version to the
    checkpoint folder and read back, as the silver layer of a daily run.
    ``hot_keys`` are the ``hot_top`` longest journeys, if the caller has counted them already.
    """
    if materialized is None:
        materialized = store.enabled(spark)

    def build() -> Silver:
        fx = bronze_from_tables(spark, sf_dir, with_duplicates, materialized)
        hot = hot_keys
        if hot is None and hot_top:
            hot = detect_hot_keys(fx.scans, "shipment_id", fraction=1.0, top=hot_top)
        return build_silver(fx.shipments, fx.scans, fx.hubs, fx.distances, dedupe=dedupe, hot_keys=hot)

    if not materialized:
        return build()
    key = silver_key(spark, sf_dir, dedupe, with_duplicates, hot_top)
    # hot journeys would make a bucket too large: with them the stays are not clustered
    stays = store.materialize(spark, lambda: build().stays, "silver_stays", key, None if hot_top else CLUSTER)
    return Silver(None, None, stays, R.hub_master(spark), R.city_distances(spark))


def bronze_from_tables(spark: SparkSession, sf_dir: str, with_duplicates: bool = False,
                       materialized: bool | None = None) -> fixtures.Fixture | Bronze:
    """Shipments and scans derived from the star-schema tables (the bronze layer).

    Stored once per input version when materialization is on, so every
    report on raw shipments/scans, and the silver build, reads Parquet files
    like a real landing instead of re-deriving them.
    """
    if materialized is None:
        materialized = store.enabled(spark)
    if not materialized:
        return fixtures.build(spark, sf_dir, with_duplicates=with_duplicates)
    vs = store.materialize(spark, lambda: fixtures.visit_rows(spark, sf_dir), "bronze_visits",
                           silver_key(spark, sf_dir))
    return Bronze(spark, sf_dir, fixtures.build(spark, sf_dir, with_duplicates=with_duplicates, visit_frame=vs), with_duplicates)


class Bronze:
    """The stored bronze layer; a table is written when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, fixture: fixtures.Fixture, with_duplicates: bool):
        self._spark, self._fixture = spark, fixture
        # duplicates are of scans only, so both landings share one table of shipments
        self._keys = {"shipments": silver_key(spark, sf_dir),
                      "scans": silver_key(spark, sf_dir, with_duplicates=with_duplicates)}
        self.hubs, self.cities, self.distances = fixture.hubs, fixture.cities, fixture.distances

    def _stored(self, name: str) -> DataFrame:
        return store.materialize(self._spark, getattr(self._fixture, name), f"bronze_{name}", self._keys[name])

    @property
    def shipments(self) -> DataFrame:
        return self._stored("shipments")

    @property
    def scans(self) -> DataFrame:
        return self._stored("scans")


def silver_key(spark: SparkSession, sf_dir: str, dedupe: bool = False, with_duplicates: bool = False,
               hot_top: int | None = None) -> str:
    """Version key of a silver build: input file fingerprint + build options."""
    base = sf_dir.rstrip("/")
    return store.fingerprint(spark, [f"{base}/lineitem.parquet", f"{base}/orders.parquet"],
                             f"dedupe={dedupe};dup={with_duplicates};hot={hot_top};v1")


def dark_from_tables(spark: SparkSession, sf_dir: str, leg: str = "inbound") -> DataFrame:
    """Dark-period table over the silver stays, stored once per silver version.

    Every dark-period report (routes, hub rates, label totals, top gaps) then
    reads it directly instead of re-running the per-journey window.
    """
    sv = silver_from_tables(spark, sf_dir)
    if not store.enabled(spark):
        return D.dark_periods(sv.stays, sv.distances, leg=leg)
    key = silver_key(spark, sf_dir) + f"-{leg}"
    return store.materialize(spark, lambda: D.dark_periods(sv.stays, sv.distances, leg=leg), "dark_periods", key, CLUSTER)


def as_text(df: DataFrame) -> DataFrame:
    """Render timestamp / date columns as text ('yyyy-MM-dd HH:mm:ss' / 'yyyy-MM-dd')."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register_views(spark: SparkSession, silver: Silver, prefix: str = "") -> list[str]:
    """Expose the silver table and the gold views to SQL users."""
    views = {
        "shipping_silver": silver.stays,
        "total_time_by_hub": G.total_time_by_hub(silver.stays),
        "worst_carrier": G.carrier_delay(silver.stays),
        "dark_periods": D.dark_periods(silver.stays, silver.distances, hot=silver.hot),
        "sla_status": S.sla_status(silver.stays),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]


# Views that read written tables, so that they outlive the session.
VIEWS = {
    "worst_carrier": "SELECT * FROM {carrier_delay} WHERE rnk = 1",
    "dark_by_extra_hours": "SELECT * FROM {dark_periods} WHERE extra_hrs IS NOT NULL ORDER BY extra_hrs DESC, shipment_id, event_id",
}


def persist_views(spark: SparkSession, gold: str, database: str = "default") -> list[str]:
    """Gold tables as external tables, and views over them, in a database of the session's catalog."""
    from transitlens.sources.files import listed
    from transitlens.sources.sinks import register_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    base, sources = gold.rstrip("/"), {}
    for name in ("carrier_delay", "dark_periods"):
        sources[name] = f"{database}.{name}"
        register_table(spark, sources[name], f"{base}/{name}")
    if listed(spark, f"{base}/dark_periods_hot"):      # hot journeys lie beside the others
        register_table(spark, f"{database}.dark_periods_hot", f"{base}/dark_periods_hot")
        sources["dark_periods"] = f"(SELECT * FROM {database}.dark_periods UNION ALL SELECT * FROM {database}.dark_periods_hot)"
    for name, sql in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql.format(**sources)}")
    return [f"{database}.{name}" for name in VIEWS]
