"""Road distance between two points, as native column expressions.

The reference takes the ellipsoidal geodesic distance on WGS-84, multiplies
it by a road factor and rounds to 0.1 km. Here the inverse geodesic is
Vincenty's, with a fixed number of iterations (each a projection), which is
exact to well under a millimetre for points that are not nearly antipodal.
The oracle's values come from another method (numerical integration), and
they agree for all pairs of the fixed city list.

Every step is a projection of its own, so that each intermediate is computed
once per row; as a single nested expression the shared terms would be
repeated many times.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.constants import ROAD_FACTOR, WGS84_A_KM, WGS84_F


ITERATIONS = 9


def _rad(c: Column) -> Column:
    return c * F.lit(math.pi) / F.lit(180.0)


def _sq(c: Column) -> Column:
    return c * c


def with_road_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str, out: str,
                 road_factor: float = ROAD_FACTOR) -> DataFrame:
    """Add ``out`` = round(geodesic km x road_factor, 1); 0 for identical points."""
    f, fv, one = F.lit(WGS84_F), WGS84_F, F.lit(1.0)
    names = ["u1", "u2", "dl", "lam", "su", "cs", "s", "sa", "ca", "cm"]
    c = {k: F.col(f"_geo_{k}") for k in names}
    put = lambda d, **cols: d.withColumns({f"_geo_{k}": v for k, v in cols.items()})
    df = put(df, u1=F.atan((one - f) * F.tan(_rad(F.col(lat1)))), u2=F.atan((one - f) * F.tan(_rad(F.col(lat2)))),
             dl=_rad(F.col(lon2)) - _rad(F.col(lon1)))
    df = put(df, lam=c["dl"])
    for i in range(ITERATIONS):
        df = put(df, su=F.sqrt(_sq(F.cos(c["u2"]) * F.sin(c["lam"]))
                               + _sq(F.cos(c["u1"]) * F.sin(c["u2"]) - F.sin(c["u1"]) * F.cos(c["u2"]) * F.cos(c["lam"]))),
                 cs=F.sin(c["u1"]) * F.sin(c["u2"]) + F.cos(c["u1"]) * F.cos(c["u2"]) * F.cos(c["lam"]))
        df = put(df, s=F.atan2(c["su"], c["cs"]),
                 sa=F.when(c["su"] == 0, F.lit(0.0)).otherwise(
                     F.cos(c["u1"]) * F.cos(c["u2"]) * F.sin(c["lam"]) / F.nullif(c["su"], F.lit(0.0))))
        df = put(df, ca=one - _sq(c["sa"]))
        df = put(df, cm=F.when(c["ca"] == 0, F.lit(0.0)).otherwise(
            c["cs"] - 2 * F.sin(c["u1"]) * F.sin(c["u2"]) / F.nullif(c["ca"], F.lit(0.0))))
        if i < ITERATIONS - 1:
            k = F.lit(fv / 16) * c["ca"] * (F.lit(4.0) + f * (F.lit(4.0) - 3 * c["ca"]))
            df = put(df, lam=c["dl"] + (one - k) * f * c["sa"] * (
                c["s"] + k * c["su"] * (c["cm"] + k * c["cs"] * (2 * _sq(c["cm"]) - 1))))
    w = c["ca"] * F.lit((1 - (1 - fv) ** 2) / (1 - fv) ** 2)
    big = one + w / 16384 * (4096 + w * (w * (320 - 175 * w) - 768))
    small = w / 1024 * (256 + w * (w * (74 - 47 * w) - 128))
    df = put(df, sa=big, ca=small)
    bend = c["ca"] * c["su"] * (c["cm"] + c["ca"] / 4 * (
        c["cs"] * (2 * _sq(c["cm"]) - 1) - c["ca"] / 6 * c["cm"] * (4 * _sq(c["su"]) - 3) * (4 * _sq(c["cm"]) - 3)))
    km = F.lit(WGS84_A_KM * (1 - fv)) * c["sa"] * (c["s"] - bend)
    df = df.withColumn(out, F.when(c["su"] == 0, F.lit(0.0)).otherwise(F.round(km * F.lit(road_factor), 1)))
    return df.drop(*[f"_geo_{k}" for k in names])
