"""De-duplication (F1) and schema-tolerant append (F2).

Duplicates are removed with a grouped ``min``/``max`` over a struct rather
than a ``row_number`` window: the aggregate is combined map-side, so even a
key that holds a large share of all copies is collapsed before the shuffle
instead of landing whole in one task. The choice of survivor is
deterministic (smallest remaining columns, or newest ``newest_by``).

Such an aggregate sorts all rows of a task. Scans are many and a scan has few
copies, so they are shuffled by their keys first: a task then sorts its shuffle
partition, not the whole file split that it reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCAN_KEYS = ["shipment_id", "hub_name", "scan_type", "scan_timestamp"]
SHIPMENT_KEYS = ["shipment_id"]


def dedup(df: DataFrame, keys: list[str], newest_by: str | None = None) -> DataFrame:
    """One row per ``keys``; with ``newest_by`` the row with the largest value wins."""
    others = [c for c in df.columns if c not in keys and c != newest_by]
    if newest_by is None:
        if not others:
            return df.select(*keys).distinct()
        pick = F.min(F.struct(*others)).alias("_keep")
        return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_keep.{c}").alias(c) for c in others]).select(*df.columns)
    pick = F.max(F.struct(newest_by, *others)).alias("_keep")
    return (df.groupBy(*keys).agg(pick)
              .select(*keys, *[F.col(f"_keep.{c}").alias(c) for c in [newest_by, *others]])
              .select(*df.columns))


def dedup_scans(scans: DataFrame, newest_by: str | None = None, dealt_by: list[str] = SCAN_KEYS) -> DataFrame:
    """Scan events keyed by what was scanned, where and when (event ids restart per run); newest file wins.

    ``dealt_by`` are those of the keys that the scans are shuffled by.
    """
    return dedup(scans.repartition(*dealt_by), SCAN_KEYS, newest_by)


def dedup_shipments(shipments: DataFrame, newest_by: str | None = None) -> DataFrame:
    """One row per shipment_id (ids can collide across runs); newest file wins."""
    return dedup(shipments, SHIPMENT_KEYS, newest_by)


def append_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing from a part become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
