"""Gold tables kept up to date by scan date.

Every report is a sum over scan dates, so its measures are stored by date
(``gold_by_date``): a run replaces the measures of the dates that it touched,
which takes back what they counted before, and the reports are merged from the
measures, a few rows a date. Silver is read for the touched dates alone.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from transitlens.operators import dark as D
from transitlens.operators import delay as G
from transitlens.operators import sla as S
from transitlens.sources.files import names
from transitlens.sources.journeys import DATE, NO_DATE, in_dates, remove_date
from transitlens.sources.sinks import write_gold, write_silver

JOBS = 4                 # Spark jobs at a time


def measures(stays: DataFrame, dark: DataFrame) -> dict[str, DataFrame]:
    """The measures of each scan date, by table."""
    return {
        "hub_delay": G.delay_sums(stays, "hub_name"),
        "carrier_delay": G.delay_sums(stays, "carrier_name"),
        "hub_dwell": G.dwell_sums(stays),
        "sla": S.sla_sums(S.sla_status(stays)),
        "dark_routes": D.route_sums(dark),
        "dark_hubs": D.hub_sums(dark),
    }


def reports(by_date: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The gold reports, merged from the measures of all dates."""
    hubs = G.total_time_of(by_date["hub_delay"])
    return {
        "total_time_by_hub": hubs,
        "worst_day_each_hub": G.worst_day_each_hub(hubs),
        "carrier_delay": G.carrier_delay_of(by_date["carrier_delay"]),
        "hub_bottleneck_ranking": G.hub_bottleneck_of(by_date["hub_dwell"]),
        "sla_breach_by_zone": S.breaches_of(by_date["sla"], "zone"),
        "sla_breach_by_carrier": S.breaches_of(by_date["sla"], "carrier_name"),
        "sla_share": S.sla_share_of(by_date["sla"]),
        "worst_routes": D.worst_routes_of(by_date["dark_routes"]),
        "dark_rate_by_hub": D.dark_rate_of(by_date["dark_hubs"]),
    }


def _replace_dates(spark: SparkSession, df: DataFrame, path: str, dates: list, small: bool = True) -> DataFrame:
    """The table's rows of ``dates`` become ``df``; a date has one file. Sums (``small``) are held while they are written."""
    rows = df.persist() if small else df
    write_silver(rows.repartition(DATE), path)
    fresh = {r[DATE] for r in rows.select(DATE).distinct().collect()}
    if small:
        rows.unpersist()
    for d in dates:
        if d not in fresh:
            remove_date(spark, path, d)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)


def refresh(spark: SparkSession, lake: str, stays: DataFrame, dark: DataFrame, dates: list) -> dict[str, str]:
    """Bring the gold tables up to date for scan dates whose stays or dark periods may have changed. Their paths."""
    base, own = f"{lake}/gold", f"{lake}/gold_by_date"
    stays, dark = stays.filter(in_dates(dates)), dark.filter(in_dates(dates))
    with ThreadPoolExecutor(JOBS) as pool:      # the tables don't depend on each other
        status = pool.submit(_replace_dates, spark, S.sla_status(stays), f"{base}/sla_status", dates, small=False)
        stored = {n: pool.submit(_replace_dates, spark, df, f"{own}/{n}", dates) for n, df in measures(stays, dark).items()}
        stored = {n: job.result() for n, job in stored.items()}
        out = {n: pool.submit(write_gold, df, f"{base}/{n}") for n, df in reports(stored).items()}
        status.result()
        return {"sla_status": f"{base}/sla_status", **{n: job.result() for n, job in out.items()}}


def rebuild(spark: SparkSession, lake: str, stays: DataFrame, dark: DataFrame, path: str) -> dict[str, str]:
    """All gold tables anew, from every date folder of the silver table at ``path``."""
    import datetime as dt

    values = [n.split("=", 1)[1] for n in names(spark, path) if n.startswith(f"{DATE}=")]
    return refresh(spark, lake, stays, dark, [None if v == NO_DATE else dt.date.fromisoformat(v) for v in values])
