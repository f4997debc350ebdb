"""What the bronze inputs shuffle and what the landings of the queries write."""

import pytest
from pyspark.sql import functions as F

from transitlens.operators import skew
from transitlens.plans import catalog, layers
from transitlens.sources import fixtures


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame([(k, p, s, n, 10.0 * n) for k, p, s in ((1, 7, 3), (2, 50, 41), (4, 9, 80)) for n in (2, 1)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5), (2, 12), (3, 9), (None, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_visit_rows_are_numbers_beside_the_id(spark, tables):
    rows = fixtures.visit_rows(spark, tables)
    assert [f.name for f in rows.schema if f.dataType.simpleString() in ("string", "timestamp")] == ["shipment_id"]
    got = sorted(tuple(r) for r in rows.select("l_orderkey", "seq", "n", "base_min", "city_ix", "origin_ix", "dest_ix", "o_custkey").collect())
    first = (11 + 9) * 60     # dwell of 10 % 20 + 1 hours, travel of 7 % 30 + 2
    assert got == [(1, 1, 2, 0, 3, 3, 3, 5), (1, 2, 2, first, 3, 3, 3, 5), (2, 1, 2, 0, 1, 1, 1, 12), (2, 2, 2, (11 + 22) * 60, 1, 1, 1, 12)]


def test_shipments_and_scans_of_visits(spark, tables):
    fx = fixtures.build(spark, tables)
    assert sorted(r[0] for r in fx.shipments.select("shipment_id").collect()) == ["SHP-1", "SHP-2"]
    scans = fx.scans.groupBy("shipment_id").agg(F.sort_array(F.collect_list("event_id")).alias("e")).orderBy("shipment_id").collect()
    assert [r["e"] for r in scans] == [[f"EVT-{k}-{n}{x}" for n in (1, 2) for x in "AD"] for k in (1, 2)]


class Landed(Exception):
    pass


def test_intake_lands_compressed_json(spark, tables, monkeypatch):
    from transitlens.plans import daily
    from transitlens.sources.files import names
    from transitlens.streaming import ingest

    def feed(spark_, source, lake, dataset, *rest):
        if dataset == "checkpoint_scan_events":
            raise Landed(names(spark_, f"{source}/0"), rest[-1])

    monkeypatch.setattr(daily, "land_rows", lambda *a: None)
    monkeypatch.setattr(ingest, "feed_lake", feed)
    with pytest.raises(Landed) as got:
        catalog.q_intake_worst_routes(spark, tables)
    files, pattern = got.value.args
    parts = [n for n in files if n.startswith("part-")]
    assert parts and all(n.endswith(".json.gz") for n in parts) and pattern == "*.json*"


def test_hot_split_counts_the_scans_once(spark, tables, monkeypatch):
    seen, real = [], skew.detect_hot_keys
    count = lambda *a, **k: (seen.append(a), real(*a, **k))[1]
    monkeypatch.setattr(skew, "detect_hot_keys", count)
    monkeypatch.setattr(layers, "detect_hot_keys", count)
    catalog.q_worst_routes_hot_split(spark, tables).collect()
    assert len(seen) == 1


def test_gzipped_json_is_taken_in_as_a_whole(spark, tables, tmp_path):
    from transitlens import schemas
    from transitlens.plans.layers import as_text
    from transitlens.streaming.ingest import ingest_incremental

    scans = as_text(fixtures.build(spark, tables).scans)
    for part in (0, 1):
        scans.filter(F.col("event_id").endswith("AD"[part])).write.option("compression", "gzip").json(f"{tmp_path}/in/{part}")
        got = ingest_incremental(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", schemas.SCAN_EVENTS, "json", "*.json*")
        assert got["rows"] == 4
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.filter("_rejected").count() == 0
    assert sorted(map(tuple, as_text(out.select(*scans.columns)).collect())) == sorted(map(tuple, scans.collect()))
