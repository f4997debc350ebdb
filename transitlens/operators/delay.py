"""Gold delay rollups: per hub-day, per carrier, worst days, bottleneck ranking.

"Delayed" here follows the gold rules: a stay counts as delayed when its
shipment's delay_profile is major or minor, and its whole-hour delay
(TOTAL_TIME) is summed when above 2 h. Averages are ROUND(x, 2) with NULL
when nothing is delayed, computed from integer sums (exact, order-free).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens import constants as K
from transitlens.functions.numeric import from_cents, ratio2, round_div_int
from transitlens.functions.temporal import day_name
from transitlens.operators.ranking import rank_by


def with_total_time(stays: DataFrame) -> DataFrame:
    """total_time = (dwell hours - expected) rounded half away from zero, as int."""
    return stays.withColumn("total_time", round_div_int("delay_seconds", F.lit(3600)).cast("int"))


def _delay_measures(min_hrs: int = K.GOLD_DELAY_MIN_HRS) -> list:
    return [
        F.count("shipment_id").alias("total_shipment_of_day"),
        F.count(F.when(F.col("delay_profile").isin(*K.DELAYED_PROFILES), F.lit(1)))
         .alias("total_delay_shipments_of_day"),
        F.sum(F.when(F.col("total_time") > min_hrs, F.col("total_time")).otherwise(F.lit(0)))
         .cast("bigint").alias("total_delay_hrs_of_day"),
    ]


def _with_avg_and_score(df: DataFrame) -> DataFrame:
    """P13 + P15: avg = ROUND(hours / NULLIF(delayed, 0), 2); score = delayed x avg."""
    avg = ratio2("total_delay_hrs_of_day", "total_delay_shipments_of_day")
    return (df.withColumn("avg_delay_hours_of_day", avg)
              .withColumn("bottleneck_score",
                          from_cents(F.round(F.col("avg_delay_hours_of_day") * 100).cast("bigint")
                                     * F.col("total_delay_shipments_of_day"))))


def hub_day_gold(silver: DataFrame, min_hrs: int = K.GOLD_DELAY_MIN_HRS) -> DataFrame:
    """A3: per (hub_name, timestamp_date) shipments, delayed, delay hours, average."""
    agg = silver.groupBy("hub_name", "timestamp_date").agg(*_delay_measures(min_hrs))
    return agg.withColumn("avg_delay_hours_of_day",
                          ratio2("total_delay_hrs_of_day", "total_delay_shipments_of_day"))


def total_time_by_hub(silver: DataFrame, min_hrs: int = K.GOLD_DELAY_MIN_HRS) -> DataFrame:
    """A4: hub-day rollup + bottleneck score + day name (the TOTAL_TIME_BY_HUB view)."""
    return total_time_of(silver.groupBy("hub_name", "timestamp_date").agg(*_delay_measures(min_hrs)))


def total_time_of(sums: DataFrame) -> DataFrame:
    """A4 from the measures of each (hub, date)."""
    return _with_avg_and_score(sums).withColumn("day_of_week", day_name("timestamp_date"))


def delay_sums(silver: DataFrame, key: str, min_hrs: int = K.GOLD_DELAY_MIN_HRS) -> DataFrame:
    """A3-A5 by date: the delay measures of each (key, scan date); they add up over dates."""
    return silver.groupBy(key, "timestamp_date").agg(*_delay_measures(min_hrs))


def carrier_delay(silver: DataFrame, grain: str = "overall",
                  null_scores: str = "last", min_hrs: int = K.GOLD_DELAY_MIN_HRS) -> DataFrame:
    """A5 + W5: per-carrier delay measures, bottleneck score and rank.

    ``grain="overall"`` is the reference: one row per carrier, ranked inside
    its own carrier (so rnk is always 1). ``grain="daily"`` groups by
    (carrier, date) and ranks carriers against each other within each date.
    """
    if grain == "overall":
        keys, part = ["carrier_name"], ["carrier_name"]
    elif grain == "daily":
        keys, part = ["carrier_name", "timestamp_date"], ["timestamp_date"]
    else:
        raise ValueError(f"grain must be 'overall' or 'daily', got {grain!r}")
    return _ranked_carriers(silver.groupBy(*keys).agg(*_delay_measures(min_hrs)), part, null_scores)


def carrier_delay_of(sums: DataFrame, null_scores: str = "last") -> DataFrame:
    """A5 + W5 overall, from the measures of each (carrier, date)."""
    measures = ["total_shipment_of_day", "total_delay_shipments_of_day", "total_delay_hrs_of_day"]
    return _ranked_carriers(sums.groupBy("carrier_name").agg(*[F.sum(m).alias(m) for m in measures]), ["carrier_name"], null_scores)


def _ranked_carriers(sums: DataFrame, part: list[str], null_scores: str) -> DataFrame:
    agg = _with_avg_and_score(sums)
    if "timestamp_date" in part:
        agg = agg.withColumn("day_of_week", day_name("timestamp_date"))
    return rank_by(agg, part, "bottleneck_score", null_scores, out="rnk")


def worst_carrier(silver: DataFrame, null_scores: str = "last") -> DataFrame:
    """O2: the single carrier with the highest bottleneck score."""
    order = F.desc_nulls_last if null_scores == "last" else F.desc_nulls_first
    return (carrier_delay(silver, "overall", null_scores)
            .filter(F.col("rnk") == 1)
            .orderBy(order("bottleneck_score"), "carrier_name")
            .limit(1))


def _avg2_int(col: str):
    """ROUND(AVG(integer col), 2) computed exactly."""
    return ratio2(F.sum(col), F.count(col))


def _avg2_hundredths(col: str):
    """ROUND(AVG(x), 2) for x holding two-decimal values, computed exactly."""
    cents = F.round(F.col(col) * 100).cast("bigint")
    return from_cents(round_div_int(F.sum(cents), F.count(cents)))


def hub_day_averages(by_hub: DataFrame, grain: str = "date") -> DataFrame:
    """ROUND(AVG(.), 2) of the five hub-day measures.

    ``grain="date"`` (reference) groups by (hub, date, day), one row per
    group; ``grain="weekday"`` groups by (hub, day of week) across dates.
    """
    keys = {"date": ["hub_name", "timestamp_date", "day_of_week"],
            "weekday": ["hub_name", "day_of_week"]}.get(grain)
    if keys is None:
        raise ValueError(f"grain must be 'date' or 'weekday', got {grain!r}")
    return by_hub.groupBy(*keys).agg(
        _avg2_int("total_shipment_of_day").alias("avg_total_shipment_of_day"),
        _avg2_int("total_delay_shipments_of_day").alias("avg_total_delay_shipments_of_day"),
        _avg2_int("total_delay_hrs_of_day").alias("avg_total_delay_hrs_of_day"),
        _avg2_hundredths("avg_delay_hours_of_day").alias("avg_delay_hours_of_day"),
        _avg2_hundredths("bottleneck_score").alias("avg_bottleneck_score"),
    )


def worst_day_each_hub(by_hub: DataFrame, grain: str = "date", null_scores: str = "last") -> DataFrame:
    """A9 + W6 + L5 + O3: per hub, the day(s) with the highest average score.

    Ties keep every tied day (RANK). Sorted by score ascending, as the
    reference lists them.
    """
    ranked = rank_by(hub_day_averages(by_hub, grain), ["hub_name"], "avg_bottleneck_score",
                     null_scores, out="rnk")
    order = F.asc_nulls_first if null_scores == "first" else F.asc_nulls_last
    tie = ["timestamp_date"] if grain == "date" else ["day_of_week"]
    return (ranked.filter(F.col("rnk") == 1)
                  .orderBy(order("avg_bottleneck_score"), "hub_name", *tie))


def worst_hub_days(by_hub: DataFrame, n: int = 5, null_scores: str = "last") -> DataFrame:
    """The n hub-days with the highest bottleneck score (top-k report)."""
    order = F.desc_nulls_last if null_scores == "last" else F.desc_nulls_first
    return by_hub.orderBy(order("bottleneck_score"), "hub_name", "timestamp_date").limit(n)


def hub_bottleneck_ranking(stays: DataFrame) -> DataFrame:
    """A10: per hub, average dwell vs expected dwell, the excess, and a score.

    delay = max(avg dwell - expected, 0) in hours (2 decimals);
    score = delay x stays delayed by more than 1 h.
    """
    return _bottlenecks(stays.groupBy("hub_name").agg(*_dwell_measures()))


def dwell_sums(stays: DataFrame) -> DataFrame:
    """A10 by date: dwell measures of each (hub, scan date); they add up over dates, the expected dwell by its maximum."""
    return stays.groupBy("hub_name", "timestamp_date").agg(*_dwell_measures())


def hub_bottleneck_of(sums: DataFrame) -> DataFrame:
    """A10 from the measures of each (hub, date)."""
    return _bottlenecks(sums.groupBy("hub_name").agg(
        F.sum("_dwell_sec").alias("_dwell_sec"), F.sum("stays").alias("stays"),
        F.max("expected_dwell_hrs").alias("expected_dwell_hrs"), F.sum("delayed_stays").alias("delayed_stays")))


def _dwell_measures() -> list:
    return [F.sum("duration_seconds").alias("_dwell_sec"), F.count("duration_seconds").alias("stays"),
            F.max("expected_dwell_hrs").alias("expected_dwell_hrs"),
            F.count(F.when(F.col("delay_seconds") > K.NORMAL_MAX_HRS * 3600, True)).alias("delayed_stays")]


def _bottlenecks(agg: DataFrame) -> DataFrame:
    avg_cents = round_div_int(F.col("_dwell_sec") * 100, F.col("stays") * 3600)
    delay_cents = F.greatest(avg_cents - F.col("expected_dwell_hrs").cast("bigint") * 100, F.lit(0))
    return (agg.withColumn("avg_dwell_hrs", from_cents(avg_cents))
               .withColumn("delay_hrs", from_cents(delay_cents))
               .withColumn("bottleneck_score", from_cents(delay_cents * F.col("delayed_stays")))
               .drop("_dwell_sec"))


__all__ = [
    "with_total_time", "hub_day_gold", "total_time_by_hub", "carrier_delay", "worst_carrier",
    "hub_day_averages", "worst_day_each_hub", "worst_hub_days", "hub_bottleneck_ranking",
    "delay_sums", "dwell_sums", "total_time_of", "carrier_delay_of", "hub_bottleneck_of",
]
