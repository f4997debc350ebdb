"""Oracle SQL (DuckDB dialect) for every catalog query.

Each statement rebuilds shipments and scans from the ``orders`` and
``lineitem`` views with the same integer mapping as ``sources.fixtures`` and
then applies the operator semantics in plain SQL, independently of the
Spark code; road distances are values integrated here, not by its formula. Used by the correctness gate and by the tests.
"""

from __future__ import annotations

import math
from functools import lru_cache

from transitlens import constants as K


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def _values(rows) -> str:
    return ",\n    ".join("(" + ", ".join(_lit(x) for x in r) + ")" for r in rows)


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ratio2(num: str, den: str, scale: int = 1) -> str:
    """ROUND(num / (scale*den), 2), half up, num/den >= 0; NULL when den = 0."""
    return (f"(CASE WHEN ({den}) <> 0 THEN {_d(f'(({num}) * 200 + ({den}) * {scale}) // (({den}) * {2 * scale})')}"
            f" / 100.0::DOUBLE END)")


def cents(num: str, den: str, scale: int = 1) -> str:
    return f"(CASE WHEN ({den}) <> 0 THEN (({num}) * 200 + ({den}) * {scale}) // (({den}) * {2 * scale}) END)"


def pct2(part: str, whole: str) -> str:
    return f"({_d(f'(({part}) * 20000 + ({whole})) // (({whole}) * 2)')} / 100.0::DOUBLE)"


def _geodesic_km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Geodesic length by integration on the auxiliary sphere (Bessel), Simpson's rule."""
    f = K.WGS84_F
    b1, b2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    span = math.radians(lon2 - lon1)
    if lat1 == lat2 and span == 0:
        return 0.0

    def integral(g, x, y, n=64):
        h = (y - x) / n
        return h / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * g(x + i * h) for i in range(n + 1))

    omega = span
    for _ in range(30):
        north = math.cos(b1) * math.sin(b2) - math.sin(b1) * math.cos(b2) * math.cos(omega)
        east = math.cos(b2) * math.sin(omega)
        azimuth = math.atan2(east, north)
        s0 = math.sin(azimuth) * math.cos(b1)
        x = math.atan2(math.sin(b1), math.cos(azimuth) * math.cos(b1))
        y = x + math.atan2(math.hypot(north, east), math.sin(b1) * math.sin(b2) + math.cos(b1) * math.cos(b2) * math.cos(omega))
        k2 = (1 / (1 - f) ** 2 - 1) * (1 - s0 * s0)
        lag = integral(lambda t: (2 - f) / (1 + (1 - f) * math.sqrt(1 + k2 * math.sin(t) ** 2)), x, y)
        omega, last = span + f * s0 * lag, omega
        if abs(omega - last) < 1e-14:
            break
    return K.WGS84_A_KM * (1 - f) * integral(lambda t: math.sqrt(1 + k2 * math.sin(t) ** 2), x, y)


@lru_cache(maxsize=1)
def _pair_values() -> str:
    """(from city, to city, road km) of all pairs of the fixed list."""
    return _values([(a, b, round(_geodesic_km(la, lo, lb, mb) * K.ROAD_FACTOR, 1))
                    for a, la, lo in K.CITIES for b, lb, mb in K.CITIES])


def _case_ix(col: str, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(labels))
    return f"CASE {col} {whens} END"


def _zone_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} <= {_lit(float(u))} THEN {_lit(z)}" for u, z in K.ZONE_BOUNDS)
    return f"CASE {whens} ELSE {_lit(K.ZONE_BEYOND)} END"


def _sla_case(zone: str, typ: str) -> str:
    whens = " ".join(f"WHEN {zone} = {_lit(z)} AND {typ} = {_lit(t)} THEN {h}"
                     for z, hours in K.SLA_RATE_CARD.items() for t, h in zip(K.SHIPMENT_TYPES, hours))
    return f"CASE {whens} END"


def base_ctes(duplicates: bool = False, dedupe: bool = False) -> str:
    """CTEs: city, hub, pair_dist, visit, ord, vo, ship, scans, silver (stays)."""
    cities = [(i, c, lat, lon) for i, (c, lat, lon) in enumerate(K.CITIES)]
    hubs = [(h[0], h[1], h[2], h[3], h[4], h[5], h[6], h[7]) for h in K.HUBS]
    dup = ""
    scans_src = "scans"
    if duplicates:
        dup = """,
scans_dup AS (
  SELECT * FROM scans
  UNION ALL
  SELECT * FROM scans WHERE CAST(substr(shipment_id, 5) AS BIGINT) % 97 = 0)"""
        scans_src = "(SELECT DISTINCT * FROM scans_dup)" if dedupe else "scans_dup"
    stay_pairs = " OR ".join(f"(scan_type = '{a}' AND next_scan_type = '{b}')" for a, b in K.STAY_PAIRS)
    return f"""
city(city_ix, city, lat, lon) AS (VALUES
    {_values(cities)}),
hub(hub_id, hub_name, city, region, hub_type, expected_dwell_hrs, max_capacity, operating_shift) AS (VALUES
    {_values(hubs)}),
pair_dist(c1, c2, km) AS (VALUES
    {_pair_values()}),
visit AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_suppkey % 40 AS INTEGER) AS city_ix,
         CAST(l_quantity AS BIGINT) % 20 + 1 AS dwell_h,
         l_partkey % 30 + 2 AS travel_h,
         l_suppkey % 60 AS am,
         l_partkey % 60 AS dm,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS seq,
         count(*) OVER (PARTITION BY l_orderkey) AS n,
         coalesce(sum((CAST(l_quantity AS BIGINT) % 20 + 1) * 60 + (l_partkey % 30 + 2) * 60) OVER (
             PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base_min,
         first_value(CAST(l_suppkey % 40 AS INTEGER)) OVER (
             PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS origin_ix,
         last_value(CAST(l_suppkey % 40 AS INTEGER)) OVER (
             PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS dest_ix
  FROM lineitem),
ord AS (
  SELECT o_orderkey,
         concat('SHP-', o_orderkey) AS shipment_id,
         concat('ORD-', o_orderkey) AS order_id,
         concat('CUST-', o_custkey) AS customer_id,
         {_case_ix('o_custkey % 5', K.CARRIERS)} AS carrier_name,
         CASE WHEN o_orderkey % 8 <= 1 THEN 'Express' WHEN o_orderkey % 8 <= 5 THEN 'Standard'
              ELSE 'Economy' END AS shipment_type,
         CASE WHEN o_orderkey % 10 <= 6 THEN 'normal' WHEN o_orderkey % 10 <= 8 THEN 'minor'
              ELSE 'major' END AS delay_profile,
         round(0.1::DOUBLE + CAST(o_custkey % 2990 AS DOUBLE) / 100.0::DOUBLE, 2) AS weight_kg,
         TIMESTAMP '2026-03-21 00:00:00' + to_minutes(CAST((o_orderkey * 37) % 43200 AS BIGINT))
             AS booking_timestamp
  FROM orders),
vo AS (
  SELECT v.*, o.shipment_id, o.order_id, o.customer_id, o.carrier_name, o.shipment_type,
         o.delay_profile, o.weight_kg, o.booking_timestamp,
         c.city AS hub_name, oc.city AS origin_hub, dc.city AS destination_hub, h.hub_id
  FROM visit v
  JOIN ord o ON o.o_orderkey = v.l_orderkey
  LEFT JOIN city c ON c.city_ix = v.city_ix
  LEFT JOIN city oc ON oc.city_ix = v.origin_ix
  LEFT JOIN city dc ON dc.city_ix = v.dest_ix
  LEFT JOIN hub h ON h.city = c.city),
ship0 AS (
  SELECT vo.shipment_id, vo.order_id, vo.customer_id, vo.carrier_name, vo.shipment_type,
         vo.origin_hub, vo.destination_hub,
         CASE WHEN vo.origin_hub = vo.destination_hub THEN 0.0::DOUBLE ELSE pd.km END AS distance_km,
         vo.weight_kg, vo.booking_timestamp
  FROM vo LEFT JOIN pair_dist pd ON pd.c1 = vo.origin_hub AND pd.c2 = vo.destination_hub
  WHERE vo.seq = 1),
ship1 AS (SELECT *, {_zone_case('distance_km')} AS zone FROM ship0),
ship2 AS (SELECT *, {_sla_case('zone', 'shipment_type')} AS sla_hours FROM ship1),
ship AS (
  SELECT shipment_id, order_id, customer_id, carrier_name, shipment_type, origin_hub, destination_hub,
         distance_km, zone, weight_kg, booking_timestamp, sla_hours,
         booking_timestamp + to_hours(CAST(sla_hours AS BIGINT)) AS expected_delivery_ts
  FROM ship2),
scans AS (
  SELECT concat('EVT-', l_orderkey, '-', seq, 'A') AS event_id, shipment_id, hub_name, hub_id,
         CASE WHEN seq = 1 THEN 'PICKED_UP' ELSE 'ARRIVED' END AS scan_type,
         booking_timestamp + to_minutes(CAST(base_min + am AS BIGINT)) AS scan_timestamp,
         'SUCCESS' AS scan_status, delay_profile
  FROM vo
  UNION ALL
  SELECT concat('EVT-', l_orderkey, '-', seq, 'D'), shipment_id, hub_name, hub_id,
         CASE WHEN seq = n THEN 'DELIVERED' ELSE 'DEPARTED' END,
         booking_timestamp + to_minutes(CAST(base_min + dwell_h * 60 + dm AS BIGINT)),
         'SUCCESS', delay_profile
  FROM vo){dup},
joined AS (
  SELECT s.shipment_id, s.order_id, s.customer_id, s.carrier_name, s.shipment_type, s.origin_hub,
         s.destination_hub, s.distance_km, s.zone, s.weight_kg, s.booking_timestamp, s.sla_hours,
         s.expected_delivery_ts, e.delay_profile, e.event_id, e.hub_name, e.scan_status,
         e.scan_timestamp, e.scan_type, e.hub_id
  FROM ship s JOIN {scans_src} e ON e.shipment_id = s.shipment_id),
nxt AS (
  SELECT *,
         lead(scan_type) OVER (PARTITION BY shipment_id ORDER BY scan_timestamp, event_id) AS next_scan_type,
         lead(scan_timestamp) OVER (PARTITION BY shipment_id ORDER BY scan_timestamp, event_id)
             AS next_scan_timestamp
  FROM joined),
st AS (
  SELECT *,
         date_diff('second', scan_timestamp, next_scan_timestamp) AS duration_seconds,
         CAST(hour(scan_timestamp) AS INTEGER) AS timestamp_hour,
         CAST(scan_timestamp AS DATE) AS timestamp_date,
         CAST(date_diff('second', scan_timestamp, next_scan_timestamp) AS DOUBLE) / 3600.0::DOUBLE AS dwell_hours
  FROM nxt
  WHERE {stay_pairs}),
st2 AS (
  SELECT st.*, hd.hub_name AS primary_hub, coalesce(hd.expected_dwell_hrs, 0) AS expected_dwell_hrs
  FROM st LEFT JOIN hub hd ON hd.hub_id = st.hub_id),
silver AS (
  SELECT *,
         duration_seconds - CAST(expected_dwell_hrs AS BIGINT) * 3600 AS delay_seconds,
         dwell_hours - expected_dwell_hrs AS delay_hrs,
         CASE WHEN dwell_hours - expected_dwell_hrs <= 1 THEN 'normal'
              WHEN dwell_hours - expected_dwell_hrs <= 4 THEN 'minor_delay'
              ELSE 'major_delay' END AS delay_category,
         CAST(CASE WHEN duration_seconds - CAST(expected_dwell_hrs AS BIGINT) * 3600 < 0
                   THEN -((abs(duration_seconds - CAST(expected_dwell_hrs AS BIGINT) * 3600) * 2 + 3600) // 7200)
                   ELSE (abs(duration_seconds - CAST(expected_dwell_hrs AS BIGINT) * 3600) * 2 + 3600) // 7200
              END AS INTEGER) AS total_time
  FROM st2)"""


def _ts(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S') AS {alias or col.split('.')[-1]}"


def _dt(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {alias or col.split('.')[-1]}"


def _with(body: str, extra: str = "", **kw) -> str:
    return f"WITH {base_ctes(**kw)}{extra}\n{body}"


DARK = """,
dk AS (
  SELECT *,
         lag(hub_name) OVER (PARTITION BY shipment_id ORDER BY scan_timestamp, event_id) AS prev_hub,
         lead(hub_name) OVER (PARTITION BY shipment_id ORDER BY scan_timestamp, event_id) AS next_hub,
         lead(scan_timestamp) OVER (PARTITION BY shipment_id ORDER BY scan_timestamp, event_id) AS next_stay_arrival
  FROM silver),
dk2 AS (
  SELECT dk.*,
         CASE WHEN dk.{frm} = dk.hub_name THEN 0.0::DOUBLE WHEN dk.{frm} IS NULL THEN 0.0::DOUBLE
              ELSE pd.km END AS hop_distance_km
  FROM dk LEFT JOIN pair_dist pd ON pd.c1 = dk.{frm} AND pd.c2 = dk.hub_name),
dk3 AS (
  SELECT *,
         round(hop_distance_km / {speed}) AS expected_travel_hrs,
         date_diff('hour', next_scan_timestamp, next_stay_arrival) AS actual_total_time
  FROM dk2),
dark AS (
  SELECT *,
         actual_total_time - expected_travel_hrs AS extra_hrs,
         CASE WHEN hop_distance_km = 0 AND prev_hub IS NULL THEN 'Staring Point'
              WHEN actual_total_time IS NULL THEN 'Final Delivery'
              WHEN hop_distance_km = 0 THEN 'Same Hub Movement'
              WHEN actual_total_time > expected_travel_hrs THEN 'Dark Period'
              ELSE 'Normal' END AS visibility_status
  FROM dk3)"""


def _dark(frm: str = "prev_hub") -> str:
    return DARK.format(frm=frm, speed=K.TRUCK_SPEED_KMPH)


SLA = """,
sla AS (
  SELECT *,
         CASE WHEN expected_delivery_ts < next_scan_timestamp THEN 'SLA Breach'
              WHEN expected_delivery_ts > next_scan_timestamp THEN 'SLA Completed'
              ELSE 'SLA Met Exactly' END AS delivery_sla
  FROM silver WHERE next_scan_type = 'DELIVERED')"""

GOLD_MEASURES = """count(shipment_id) AS total_shipment_of_day,
         count(CASE WHEN delay_profile IN ('major', 'minor') THEN 1 END) AS total_delay_shipments_of_day,
         CAST(sum(CASE WHEN total_time > 2 THEN total_time ELSE 0 END) AS BIGINT) AS total_delay_hrs_of_day"""

BY_HUB = f""",
hd AS (
  SELECT hub_name, timestamp_date, {GOLD_MEASURES}
  FROM silver GROUP BY hub_name, timestamp_date),
by_hub AS (
  SELECT *, {ratio2('total_delay_hrs_of_day', 'total_delay_shipments_of_day')} AS avg_delay_hours_of_day,
         {_d(cents('total_delay_hrs_of_day', 'total_delay_shipments_of_day') + ' * total_delay_shipments_of_day')}
             / 100.0::DOUBLE AS bottleneck_score,
         strftime(timestamp_date, '%a') AS day_of_week
  FROM hd)"""


def _carrier(keys: str, part: str) -> str:
    return f""",
cg AS (SELECT {keys}, {GOLD_MEASURES} FROM silver GROUP BY {keys}),
cd AS (
  SELECT *, {ratio2('total_delay_hrs_of_day', 'total_delay_shipments_of_day')} AS avg_delay_hours_of_day,
         {_d(cents('total_delay_hrs_of_day', 'total_delay_shipments_of_day') + ' * total_delay_shipments_of_day')}
             / 100.0::DOUBLE AS bottleneck_score
  FROM cg),
cr AS (
  SELECT *, CAST(rank() OVER (PARTITION BY {part} ORDER BY bottleneck_score DESC NULLS LAST) AS INTEGER) AS rnk
  FROM cd)"""


def _avg_hundredths(col: str) -> str:
    c = f"CAST(round({col} * 100) AS BIGINT)"
    return f"({_d(f'CASE WHEN count({c}) <> 0 THEN ({_round_div(f"sum({c})", f"count({c})")}) END')} / 100.0::DOUBLE)"


def _round_div(n: str, d: str) -> str:
    """round(n/d) half away from zero for integers, d > 0."""
    return (f"CASE WHEN ({n}) < 0 THEN -((abs({n}) * 2 + ({d})) // (({d}) * 2)) "
            f"ELSE (({n}) * 2 + ({d})) // (({d}) * 2) END")


def _hub_day_avgs(keys: str) -> str:
    return f""",
avgs AS (
  SELECT {keys},
         {ratio2('sum(total_shipment_of_day)', 'count(total_shipment_of_day)')} AS avg_total_shipment_of_day,
         {ratio2('sum(total_delay_shipments_of_day)', 'count(total_delay_shipments_of_day)')}
             AS avg_total_delay_shipments_of_day,
         {ratio2('sum(total_delay_hrs_of_day)', 'count(total_delay_hrs_of_day)')} AS avg_total_delay_hrs_of_day,
         {_avg_hundredths('avg_delay_hours_of_day')} AS avg_delay_hours_of_day,
         {_avg_hundredths('bottleneck_score')} AS avg_bottleneck_score
  FROM by_hub GROUP BY {keys}),
ranked AS (
  SELECT *, CAST(rank() OVER (PARTITION BY hub_name ORDER BY avg_bottleneck_score DESC {{nulls}}) AS INTEGER) AS rnk
  FROM avgs)"""


AVG_COLS = ("avg_total_shipment_of_day, avg_total_delay_shipments_of_day, avg_total_delay_hrs_of_day, "
            "avg_delay_hours_of_day, avg_bottleneck_score, rnk")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["shipment_zone_sla"] = _with(f"""
SELECT shipment_id, order_id, customer_id, carrier_name, shipment_type, origin_hub, destination_hub,
       distance_km, zone, weight_kg, {_ts('booking_timestamp')}, sla_hours, {_ts('expected_delivery_ts')}
FROM ship""")
    q["shipment_profile"] = _with("""
SELECT 'zone' AS dimension, zone AS value, count(*) AS shipments FROM ship GROUP BY zone
UNION ALL SELECT 'shipment_type', shipment_type, count(*) FROM ship GROUP BY shipment_type
UNION ALL SELECT 'carrier_name', carrier_name, count(*) FROM ship GROUP BY carrier_name
UNION ALL SELECT 'total', 'all', count(*) FROM ship""")
    q["shipment_scans"] = _with(f"""
SELECT shipment_id, order_id, customer_id, carrier_name, shipment_type, origin_hub, destination_hub,
       distance_km, zone, weight_kg, {_ts('booking_timestamp')}, sla_hours, {_ts('expected_delivery_ts')},
       delay_profile, event_id, hub_name, scan_status, {_ts('scan_timestamp')}, scan_type, hub_id
FROM joined""")
    q["hub_stays"] = _with(f"""
SELECT shipment_id, event_id, hub_name, hub_id, scan_type, {_ts('scan_timestamp')}, next_scan_type,
       {_ts('next_scan_timestamp')}, duration_seconds, dwell_hours, {_dt('timestamp_date')}, timestamp_hour
FROM silver""")
    q["stay_delays"] = _with("""
SELECT shipment_id, event_id, hub_name, hub_id, primary_hub, expected_dwell_hrs, dwell_hours, delay_hrs,
       delay_category
FROM silver""")
    q["hub_day_silver"] = _with(f"""
SELECT hub_name, {_dt('timestamp_date')}, min(hub_id) AS hub_id,
       count(shipment_id) AS total_shipments_of_day,
       count(CASE WHEN delay_category IN ('minor_delay', 'major_delay') THEN true END) AS delayed_shipments_of_day,
       {_d('sum(CASE WHEN delay_seconds > 3600 THEN delay_seconds ELSE 0 END)')} / 3600.0::DOUBLE
           AS total_delay_hours_of_day,
       CASE WHEN count(CASE WHEN delay_category IN ('minor_delay', 'major_delay') THEN true END) <> 0
            THEN {ratio2('sum(CASE WHEN delay_seconds > 3600 THEN delay_seconds ELSE 0 END)',
                         "count(CASE WHEN delay_category IN ('minor_delay', 'major_delay') THEN true END)", 3600)}
            ELSE 0.0::DOUBLE END AS avg_delay_hours_of_day
FROM silver GROUP BY hub_name, timestamp_date""")
    q["hub_day_gold"] = _with(f"""
SELECT hub_name, {_dt('timestamp_date')}, total_shipment_of_day, total_delay_shipments_of_day,
       total_delay_hrs_of_day, avg_delay_hours_of_day
FROM by_hub""", BY_HUB)
    q["total_time_by_hub"] = _with(f"""
SELECT hub_name, {_dt('timestamp_date')}, total_shipment_of_day, total_delay_shipments_of_day,
       total_delay_hrs_of_day, avg_delay_hours_of_day, bottleneck_score, day_of_week
FROM by_hub""", BY_HUB)
    q["dark_periods"] = _with("""
SELECT shipment_id, event_id, hub_name, prev_hub, hop_distance_km, expected_travel_hrs, actual_total_time,
       extra_hrs, visibility_status
FROM dark""", _dark())
    q["worst_routes"] = _with("""
SELECT origin_hub, destination_hub, count(visibility_status) AS dark_periods
FROM dark WHERE visibility_status = 'Dark Period'
GROUP BY origin_hub, destination_hub
ORDER BY dark_periods DESC, origin_hub, destination_hub""", _dark())
    q["dark_rate_by_hub"] = _with(f"""
SELECT hub_name, stays, dark_periods, {pct2('dark_periods', 'stays')} AS dark_rate_pct
FROM (SELECT hub_name, count(*) AS stays,
             count(CASE WHEN visibility_status = 'Dark Period' THEN true END) AS dark_periods
      FROM dark GROUP BY hub_name)""", _dark())
    vis = """
SELECT visibility_status, count(*) AS stays, CAST(sum(actual_total_time) AS BIGINT) AS actual_hours
FROM dark GROUP BY visibility_status"""
    q["visibility_summary"] = _with(vis, _dark())
    q["visibility_summary_outbound"] = _with(vis, _dark("next_hub"))
    q["sla_status"] = _with(f"""
SELECT shipment_id, {_ts('expected_delivery_ts')}, next_scan_type, {_ts('next_scan_timestamp')}, delivery_sla
FROM sla""", SLA)
    q["sla_breach_by_zone"] = _with("""
SELECT zone, count(*) AS breached_shipments FROM sla WHERE delivery_sla = 'SLA Breach' GROUP BY zone""", SLA)
    q["sla_breach_by_carrier"] = _with("""
SELECT carrier_name, count(delivery_sla) AS breached_shipments
FROM sla WHERE delivery_sla = 'SLA Breach' GROUP BY carrier_name""", SLA)
    q["sla_status_by_zone"] = _with("""
SELECT zone, delivery_sla, count(*) AS shipments FROM sla GROUP BY zone, delivery_sla""", SLA)
    q["sla_share"] = _with(f"""
SELECT delivery_sla, shipments, {pct2('shipments', 'total')} AS share_pct
FROM (SELECT delivery_sla, shipments, CAST(sum(shipments) OVER () AS BIGINT) AS total
      FROM (SELECT delivery_sla, count(*) AS shipments FROM sla GROUP BY delivery_sla))""", SLA)
    carrier_cols = ("carrier_name, total_shipment_of_day, total_delay_shipments_of_day, total_delay_hrs_of_day, "
                    "avg_delay_hours_of_day, bottleneck_score, rnk")
    q["carrier_delay"] = _with(f"SELECT {carrier_cols} FROM cr", _carrier("carrier_name", "carrier_name"))
    q["carrier_delay_daily"] = _with(f"""
SELECT {carrier_cols}, {_dt('timestamp_date')}, strftime(timestamp_date, '%a') AS day_of_week FROM cr""",
                                     _carrier("carrier_name, timestamp_date", "timestamp_date"))
    q["worst_carrier"] = _with(f"""
SELECT {carrier_cols} FROM cr WHERE rnk = 1
ORDER BY bottleneck_score DESC NULLS LAST, carrier_name LIMIT 1""", _carrier("carrier_name", "carrier_name"))
    q["worst_day_each_hub"] = _with(f"""
SELECT hub_name, {_dt('timestamp_date')}, day_of_week, {AVG_COLS}
FROM ranked WHERE rnk = 1
ORDER BY avg_bottleneck_score ASC NULLS LAST, hub_name, timestamp_date""",
                                    BY_HUB + _hub_day_avgs("hub_name, timestamp_date, day_of_week")
                                    .replace("{nulls}", "NULLS LAST"))
    q["worst_day_each_hub_nulls_first"] = _with(f"""
SELECT hub_name, {_dt('timestamp_date')}, day_of_week, {AVG_COLS}
FROM ranked WHERE rnk = 1
ORDER BY avg_bottleneck_score ASC NULLS FIRST, hub_name, timestamp_date""",
                                                BY_HUB + _hub_day_avgs("hub_name, timestamp_date, day_of_week")
                                                .replace("{nulls}", "NULLS FIRST"))
    q["worst_weekday_each_hub"] = _with(f"""
SELECT hub_name, day_of_week, {AVG_COLS}
FROM ranked WHERE rnk = 1
ORDER BY avg_bottleneck_score ASC NULLS LAST, hub_name, day_of_week""",
                                        BY_HUB + _hub_day_avgs("hub_name, day_of_week").replace("{nulls}", "NULLS LAST"))
    q["worst_hub_days_top5"] = _with(f"""
SELECT hub_name, {_dt('timestamp_date')}, total_shipment_of_day, total_delay_shipments_of_day,
       total_delay_hrs_of_day, avg_delay_hours_of_day, bottleneck_score, day_of_week
FROM by_hub ORDER BY by_hub.bottleneck_score DESC NULLS LAST, hub_name, by_hub.timestamp_date LIMIT 5""", BY_HUB)
    avg_c = "((_dwell_sec * 200 + stays * 3600) // (stays * 7200))"
    delay_c = f"greatest({avg_c} - CAST(expected_dwell_hrs AS BIGINT) * 100, 0)"
    q["hub_bottleneck_ranking"] = _with(f"""
SELECT hub_name, stays, expected_dwell_hrs, delayed_stays,
       {_d(avg_c)} / 100.0::DOUBLE AS avg_dwell_hrs,
       {_d(delay_c)} / 100.0::DOUBLE AS delay_hrs,
       {_d(f'{delay_c} * delayed_stays')} / 100.0::DOUBLE AS bottleneck_score
FROM (SELECT hub_name, sum(duration_seconds) AS _dwell_sec, count(duration_seconds) AS stays,
             max(expected_dwell_hrs) AS expected_dwell_hrs,
             count(CASE WHEN delay_seconds > 3600 THEN true END) AS delayed_stays
      FROM silver GROUP BY hub_name)""")
    q["dedup_scans"] = _with(f"""
SELECT DISTINCT event_id, shipment_id, hub_name, hub_id, scan_type, {_ts('scan_timestamp')}, scan_status,
       delay_profile
FROM scans_dup""", duplicates=True)
    q["silver_dedup_counts"] = _with("""
SELECT delay_category, count(*) AS stays FROM silver GROUP BY delay_category""", duplicates=True, dedupe=True)
    q["scan_sequence"] = _with("""
SELECT shipment_id, event_id, scan_type,
       CAST(row_number() OVER (PARTITION BY shipment_id ORDER BY scan_timestamp, event_id) AS INTEGER) AS scan_seq
FROM scans""")
    q["hub_distances"] = _with("""
SELECT DISTINCT prev_hub AS from_city, hub_name AS to_city, hop_distance_km AS road_km
FROM dark WHERE prev_hub IS NOT NULL""", _dark())
    q["scan_time_range"] = _with(f"""
SELECT {_ts('min(scan_timestamp)', 'min_scan_timestamp')}, {_ts('max(scan_timestamp)', 'max_scan_timestamp')},
       count(*) AS rows
FROM scans""")
    q["longest_dark_periods"] = _with("""
SELECT shipment_id, event_id, hub_name, prev_hub, actual_total_time, expected_travel_hrs, extra_hrs
FROM dark WHERE visibility_status = 'Dark Period'
ORDER BY extra_hrs DESC NULLS LAST, shipment_id, event_id LIMIT 20""", _dark())
    q["dark_periods_by_extra_hours"] = _with("""
SELECT shipment_id, event_id, hub_name, prev_hub, actual_total_time, expected_travel_hrs, extra_hrs
FROM dark WHERE visibility_status = 'Dark Period'
ORDER BY extra_hrs DESC NULLS LAST, shipment_id, event_id""", _dark())
    q["shipments_by_zone"] = _with("SELECT zone, count(*) AS shipments FROM ship GROUP BY zone ORDER BY zone")
    q["daily_run_two_landings"] = q["worst_routes"]
    q["daily_run_rejects"] = _with("""
SELECT 'checkpoint_scan_events' AS dataset, 'scan_timestamp' AS reason, count(*) AS rejected
FROM scans WHERE CAST(substr(shipment_id, 5) AS BIGINT) % 50 = 0 HAVING count(*) > 0""")
    q["incremental_load_counts"] = _with("""
SELECT 1 AS run, count(*) FILTER (CAST(substr(shipment_id, 5) AS BIGINT) % 3 = 0) AS loaded FROM scans
UNION ALL SELECT 2, count(*) FILTER (CAST(substr(shipment_id, 5) AS BIGINT) % 3 <> 0) FROM scans
UNION ALL SELECT 3, 0""")
    q["daily_run_worst_routes"] = q["worst_routes"]
    q["intake_worst_routes"] = q["worst_routes"]
    q["json_layouts"] = _with("""
SELECT layout, count(*) AS loaded, count(*) FILTER (n % 50 = 0) AS rejected
FROM (SELECT CAST(substr(shipment_id, 5) AS BIGINT) AS n FROM scans) JOIN (VALUES (0, 'lines'), (1, 'elements'), (2, 'pretty')) l(k, layout) ON n % 3 = k
GROUP BY layout""")
    q["published_views"] = q["carrier_delay"]
    q["worst_routes_hot_split"] = q["worst_routes"]
    q["late_files_worst_routes"] = q["worst_routes"]
    q["evolved_table"] = q["hub_day_gold"]
    q["one_hour_journey"] = _with(f"""
SELECT event_id, scan_type, {_ts('scan_timestamp')},
       lead(event_id) OVER w AS next_event_id, lead(scan_type) OVER w AS next_scan_type, lag(event_id) OVER w AS prev_event_id,
       CAST(row_number() OVER w AS INTEGER) AS scan_seq
FROM (SELECT event_id, scan_type,
             TIMESTAMP '2026-04-01 00:00:00' + to_seconds((CAST(substr(shipment_id, 5) AS BIGINT) * 7919) % 3600) AS scan_timestamp FROM scans)
WINDOW w AS (ORDER BY scan_timestamp, event_id)""")
    return q
