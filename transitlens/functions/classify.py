"""Rule-based classifiers as CASE expressions (order of rules matters)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlens import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delay_category(delay_hrs, normal_max=K.NORMAL_MAX_HRS, minor_max=K.MINOR_MAX_HRS) -> Column:
    """<= 1 h normal, <= 4 h minor_delay, else (also NULL) major_delay."""
    d = _c(delay_hrs)
    return (F.when(d <= normal_max, F.lit(K.NORMAL))
            .when(d <= minor_max, F.lit(K.MINOR_DELAY))
            .otherwise(F.lit(K.MAJOR_DELAY)))


def zone(distance_km, bounds=K.ZONE_BOUNDS, beyond=K.ZONE_BEYOND) -> Column:
    """Distance band: Local <= 50 < Zone A <= 300 < B <= 800 < C <= 1500 < D."""
    d = _c(distance_km)
    expr = None
    for upper, label in bounds:
        expr = F.when(d <= upper, F.lit(label)) if expr is None else expr.when(d <= upper, F.lit(label))
    return expr.otherwise(F.lit(beyond))


def sla_hours(zone_col, shipment_type, card=K.SLA_RATE_CARD, types=K.SHIPMENT_TYPES) -> Column:
    """Rate-card lookup as a CASE over (zone, type); unknown pair -> NULL."""
    z, t = _c(zone_col), _c(shipment_type)
    expr = None
    for zname, hours in card.items():
        for tname, h in zip(types, hours):
            cond = (z == zname) & (t == tname)
            expr = F.when(cond, F.lit(h)) if expr is None else expr.when(cond, F.lit(h))
    return expr


def visibility_status(hop_km, prev_hub, actual_hrs, expected_hrs) -> Column:
    """Dark-period label for one hub stay (first matching rule wins)."""
    hop, prev, act, exp = _c(hop_km), _c(prev_hub), _c(actual_hrs), _c(expected_hrs)
    return (F.when((hop == 0) & prev.isNull(), F.lit(K.STARTING_POINT))
            .when(act.isNull(), F.lit(K.FINAL_DELIVERY))
            .when(hop == 0, F.lit(K.SAME_HUB))
            .when(act > exp, F.lit(K.DARK_PERIOD))
            .otherwise(F.lit(K.NORMAL_VISIBILITY)))


def delivery_sla(expected_ts, actual_ts) -> Column:
    """Breach if promised < delivered, Completed if >, else (ties, NULLs) Met Exactly."""
    e, a = _c(expected_ts), _c(actual_ts)
    return (F.when(e < a, F.lit(K.SLA_BREACH))
            .when(e > a, F.lit(K.SLA_COMPLETED))
            .otherwise(F.lit(K.SLA_EXACT)))


def is_stay_pair(scan_type, next_scan_type, pairs=K.STAY_PAIRS) -> Column:
    """True for (scan, next scan) pairs that bound a stay at one hub."""
    s, n = _c(scan_type), _c(next_scan_type)
    cond = None
    for a, b in pairs:
        c = (s == a) & (n == b)
        cond = c if cond is None else (cond | c)
    return cond
