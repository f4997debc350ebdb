"""Hot keys in per-journey windows.

A lead/lag window partitioned by ``shipment_id`` sends every row of one id to
one task. Ids can collide (the reference draws them from a small random
space), so a single id may carry a large share of all scans. For such keys:

* detection is a Bernoulli sample counted per key (partial aggregation); the
  returned list is bounded by ``1 / min_share`` keys;
* their rows are windowed per (key, segment) instead of per key, so one hot
  journey is spread over many tasks;
* segments end at quantiles of the rows' own order, taken from a sample of
  about ``SAMPLED`` rows a segment, so they are even however the scans lie in
  time: a journey with all its scans in one hour, or at one instant, is split
  by the columns that follow the time; rows without a time come first, as in
  the plain window;
* the rows at segment edges get their neighbour from a table that holds, per
  (key, segment), only the first and last row (two rows per segment, not per
  scan), stitched with a lead/lag over segments.

Any borders give the plain window's result (``tests/test_skew.py`` checks it
against the plain path), the sample only decides how even the segments are.
The borders are checkpointed, so both branches of a plan and a task that is
run again see the same ones. Rows equal in all columns of the order, which the
plain window can't tell apart either, share a segment (de-duplicate first).
A caller who knows how scans lie in time may name ``bucket_seconds`` instead;
then no sample is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.session import checkpoint_dir
from transitlens.sources.reference import bounded_broadcast, local_frame

SEGMENT_ROWS = 1_000_000  # rows of a hot key that one task windows, about
SAMPLED = 16              # sampled rows for each of its segments
MAX_SEGMENTS = 4_096      # segments of all hot keys, which bounds the broadcast borders


def detect_hot_keys(df: DataFrame, key: str, min_share: float = 0.01, fraction: float = 0.01,
                    seed: int = 17, top: int | None = None, min_sampled_rows: int = 100) -> list:
    """Keys holding at least ``min_share`` of the rows, estimated on a ``fraction`` sample.

    A key must also have ``min_sampled_rows`` rows in the sample, so that a
    small sample does not flag every id it happens to contain.

    With ``top`` the ``top`` largest keys of the sample are returned instead
    (a fixed-size list, e.g. to route the longest journeys of a run through
    the split path). Either way the list is bounded and small.
    """
    s = df.select(key).sample(fraction=fraction, seed=seed)
    counts = s.groupBy(key).count()
    if top is not None:
        rows = counts.orderBy(F.desc("count"), key).limit(top).collect()
        return [r[key] for r in rows]
    total = s.count()
    if total == 0:
        return []
    # at most 1 / min_share keys can hold that share
    rows = (counts.filter(F.col("count") >= F.lit(max(min_share * total, min_sampled_rows)))
                  .orderBy(F.desc("count"), key).collect())
    return [r[key] for r in rows]


def hot_key_frame(spark: SparkSession, key: str, keys: list, dtype: T.DataType = T.StringType()) -> DataFrame:
    schema = T.StructType([T.StructField(key, dtype, False)])
    return local_frame(spark, [(k,) for k in keys], schema)


def split_hot(df: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of normal keys, rows of hot keys), by broadcast semi/anti join on the small key list."""
    h = bounded_broadcast(hot)
    return df.join(h, key, "left_anti"), df.join(h, key, "left_semi")


def _bucket(ts_col: str, seconds: int):
    """The time bucket of a row; rows without a time come before all others."""
    return F.coalesce(F.floor(F.unix_timestamp(ts_col) / F.lit(seconds)), F.lit(-(2 ** 62)))


def _place(order: list[str]) -> Column:
    """The row's place in the order as one comparable value (NULLs first, as in the window)."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def segment_borders(rows: DataFrame, key: str, order: list[str], segment_rows: int = SEGMENT_ROWS, seed: int = 29) -> DataFrame:
    """(key, _nb_borders): for each key of ``rows`` the ascending first places of its segments but the first.

    One pass over the key and the order's columns. A key of fewer than about
    ``segment_rows`` rows has no row here. Beyond MAX_SEGMENTS segments they
    hold more rows each.
    """
    checkpoint_dir(rows.sparkSession)    # sets one in tests, where there is none
    sample = rows.select(key, _place(order).alias("_at")).sample(fraction=min(1.0, SAMPLED / segment_rows), seed=seed)
    sample = sample.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy("_at"))).checkpoint()
    step = max(SAMPLED, -(-sample.count() // MAX_SEGMENTS))
    return sample.filter(F.col("_rn") % step == 0).groupBy(key).agg(F.sort_array(F.collect_set("_at")).alias("_nb_borders")).checkpoint()


def with_segment(rows: DataFrame, key: str, order: list[str], out: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Number the segments of every key from 0, in the order's direction.

    A row's segment is found by halving: as many comparisons as the largest
    number of borders has binary digits, each a projection of its own, so that
    a row's cost hardly grows with the number of segments.
    """
    borders = segment_borders(rows, key, order, segment_rows)
    most = borders.agg(F.max(F.size("_nb_borders"))).first()[0] or 0
    # at most MAX_SEGMENTS places in all
    placed = rows.join(F.broadcast(borders), key, "left").withColumns({"_nb_at": _place(order), out: F.lit(0)})
    for step in reversed([1 << i for i in range(int(most).bit_length())]):
        # the border that follows the next ``step - 1``; null past the end, and for a key without borders
        border = F.get("_nb_borders", F.col(out) + (step - 1))
        placed = placed.withColumn(out, F.col(out) + F.when(border <= F.col("_nb_at"), step).otherwise(0))
    return placed.select(*rows.columns, out)


def _segmented(rows: DataFrame, key: str, order: list[str], out: str, bucket_seconds: int | None, ts_col: str, segment_rows: int,
               segment: str | None) -> DataFrame:
    if segment is not None:
        return rows.withColumn(out, F.col(segment))
    if bucket_seconds is not None:
        return rows.withColumn(out, _bucket(ts_col, bucket_seconds))
    return with_segment(rows, key, order, out, segment_rows)


def with_sequence(df: DataFrame, key: str, order: list[str], out: str, hot: DataFrame | None = None,
                  bucket_seconds: int | None = None, segment_rows: int = SEGMENT_ROWS, segment: str | None = None) -> DataFrame:
    """Add the 1-based position of every row in its key, ordered by ``order``.

    Hot keys are numbered per segment, plus the rows of the segments before.
    ``segment`` names a column of :func:`with_segment` that the rows have already.
    """
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    if hot is None:
        return df.withColumn(out, plain)
    normal, rows = split_hot(df, hot, key)
    b = "_nb_bucket"
    rows = _segmented(rows, key, order, b, bucket_seconds, order[0], segment_rows, segment)
    before = F.sum("_nb_n").over(Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy(key, b).agg(F.count(F.lit(1)).alias("_nb_n")) \
        .select(key, b, F.coalesce(before, F.lit(0)).alias("_nb_before"))
    numbered = rows.withColumn(out, F.row_number().over(Window.partitionBy(key, b).orderBy(*order))) \
        .join(sizes, [key, b]).withColumn(out, (F.col(out) + F.col("_nb_before")).cast("int"))
    return normal.withColumn(out, plain).unionByName(numbered.select(*df.columns, out))


def with_neighbors(df: DataFrame, key: str, order: list[str], leads: dict[str, str],
                   lags: dict[str, str], hot: DataFrame | None = None, ts_col: str | None = None,
                   bucket_seconds: int | None = None, segment_rows: int = SEGMENT_ROWS, segment: str | None = None) -> DataFrame:
    """Add lead(1)/lag(1) columns over ``key`` ordered by ``order``.

    ``leads`` / ``lags`` map output column -> source column. Without ``hot``
    this is one Window. With ``hot`` (a frame of hot key values) the hot rows
    are windowed per (key, floor(ts / bucket_seconds)) and stitched.
    ``segment`` names a column of :func:`with_segment` (over ``order`` or its
    first columns) that the rows have already.
    """
    # rows that are equal in ``order`` follow the neighbour columns, alike on both paths
    order = [*order, *sorted({*leads.values(), *lags.values()} - {*order})]
    w = Window.partitionBy(key).orderBy(*order)

    def plain(d: DataFrame) -> DataFrame:
        return d.withColumns({**{o: F.lead(c, 1).over(w) for o, c in leads.items()},
                              **{o: F.lag(c, 1).over(w) for o, c in lags.items()}})

    if hot is None:
        return plain(df)
    normal, hot_rows = split_hot(df, hot, key)

    b = "_nb_bucket"
    hot_rows = _segmented(hot_rows, key, order, b, bucket_seconds, ts_col or order[0], segment_rows, segment)
    wb = Window.partitionBy(key, b).orderBy(*order)
    wb_all = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inner = hot_rows.withColumns({
        **{f"_in_{o}": F.lead(c, 1).over(wb) for o, c in leads.items()},
        **{f"_in_{o}": F.lag(c, 1).over(wb) for o, c in lags.items()},
        "_nb_rn": F.row_number().over(wb),
        "_nb_n": F.count(F.lit(1)).over(wb_all),
    })

    # per (key, segment): its first and last row, in window order
    srcs_first = sorted(set(leads.values()))
    srcs_last = sorted(set(lags.values()))
    seg = hot_rows.groupBy(key, b).agg(
        F.min(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"v_{c}") for c in srcs_first])).alias("_first"),
        F.max(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"v_{c}") for c in srcs_last])).alias("_last"),
    )
    ws = Window.partitionBy(key).orderBy(b)
    seg = seg.select(key, b,
                     F.lead("_first", 1).over(ws).alias("_next_first"),
                     F.lag("_last", 1).over(ws).alias("_prev_last"))

    j = inner.join(seg, [key, b], "left")
    is_last = F.col("_nb_rn") == F.col("_nb_n")
    is_first = F.col("_nb_rn") == 1
    stitched = j.withColumns({
        **{o: F.when(is_last, F.col(f"_next_first.v_{c}")).otherwise(F.col(f"_in_{o}"))
           for o, c in leads.items()},
        **{o: F.when(is_first, F.col(f"_prev_last.v_{c}")).otherwise(F.col(f"_in_{o}"))
           for o, c in lags.items()},
    })
    helper = [b, "_nb_rn", "_nb_n", "_next_first", "_prev_last"] + [f"_in_{o}" for o in [*leads, *lags]]
    out_cols = df.columns + list(leads) + list(lags)
    return plain(normal).select(*out_cols).unionByName(stitched.drop(*helper).select(*out_cols))

