"""Small, fixed-size reference dimensions (cities, hubs, SLA card).

Their size is bounded by construction (40 / 16 / 15 rows), so broadcasting
them is always safe, whatever the size of the fact tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens import constants as K

CITY_SCHEMA = T.StructType([
    T.StructField("city_ix", T.IntegerType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
])

HUB_SCHEMA = T.StructType([
    T.StructField("hub_id", T.StringType(), False),
    T.StructField("hub_name", T.StringType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("region", T.StringType(), True),
    T.StructField("hub_type", T.StringType(), True),
    T.StructField("expected_dwell_hrs", T.IntegerType(), True),
    T.StructField("max_capacity", T.IntegerType(), True),
    T.StructField("operating_shift", T.StringType(), True),
])

SLA_CARD_SCHEMA = T.StructType([
    T.StructField("zone", T.StringType(), False),
    T.StructField("shipment_type", T.StringType(), False),
    T.StructField("sla_hours", T.IntegerType(), False),
])


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small constant table as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` (an RDD scan of unknown size), this plans as a
    LocalRelation whose exact size the optimizer knows, so joins against it
    are broadcast without a shuffle of the other side.
    """
    names = [f.name for f in schema.fields]
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS {n}" for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({', '.join(names)})")


_FRAMES: dict[tuple, DataFrame] = {}


def _cached(spark: SparkSession, name: str, build) -> DataFrame:
    """One plan object per session for each constant dimension (no re-parsing)."""
    key = (id(spark), spark.sparkContext.applicationId, name)
    df = _FRAMES.get(key)
    if df is None:
        df = _FRAMES[key] = build()
    return df


def cities(spark: SparkSession) -> DataFrame:
    rows = [(i, c, lat, lon) for i, (c, lat, lon) in enumerate(K.CITIES)]
    return _cached(spark, "cities", lambda: local_frame(spark, rows, CITY_SCHEMA))


def hub_master(spark: SparkSession) -> DataFrame:
    return _cached(spark, "hubs", lambda: local_frame(spark, K.HUBS, HUB_SCHEMA))


def sla_rate_card(spark: SparkSession) -> DataFrame:
    rows = [(z, t, h) for z, hours in K.SLA_RATE_CARD.items()
            for t, h in zip(K.SHIPMENT_TYPES, hours)]
    return local_frame(spark, rows, SLA_CARD_SCHEMA)


def city_distances(spark: SparkSession, road_factor: float = K.ROAD_FACTOR) -> DataFrame:
    """Directed road distances between the reference cities (1,560 rows).

    The pairs are an enumeration of the fixed 40-city list (a constant
    dimension, like the hub master), not of data; Spark evaluates the
    geodesic on them once and every fact row then does one broadcast hash
    probe on (from_city, to_city) instead of per-row trigonometry.
    """
    from transitlens.functions.geo import with_road_km

    pairs = [(a, la, lo, b, lb, mb) for a, la, lo in K.CITIES for b, lb, mb in K.CITIES if a != b]
    schema = T.StructType([
        T.StructField("from_city", T.StringType(), False),
        T.StructField("from_lat", T.DoubleType(), False),
        T.StructField("from_lon", T.DoubleType(), False),
        T.StructField("to_city", T.StringType(), False),
        T.StructField("to_lat", T.DoubleType(), False),
        T.StructField("to_lon", T.DoubleType(), False),
    ])
    return _cached(spark, f"distances:{road_factor!r}", lambda: with_road_km(
        local_frame(spark, pairs, schema), "from_lat", "from_lon", "to_lat", "to_lon", "road_km", road_factor
    ).select("from_city", "to_city", "road_km"))


# Hard cap on what we ever hint for broadcast, whatever the session threshold.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (file size for scans, exact for local data)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. Connect): unknown size
        return None


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is within ``max_bytes``.

    The fixed dimensions above are a few KB, so they are always hinted. A
    user-supplied dimension that turns out larger is returned unhinted and the
    planner falls back to a shuffle join (AQE may still broadcast it at run
    time when its real size is small).
    """
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df
