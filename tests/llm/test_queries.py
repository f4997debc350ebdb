"""Queries with SQL against DuckDB on the small tables."""

import duckdb
import pytest
from rows_util import SMALL, ordered

from transitlens.llm.queries import ORACLE_SQL, QUERIES


def _plain(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = db.execute(ORACLE_SQL[name])
    columns = sorted(c[0] for c in want.description)
    rows = [dict(zip([c[0] for c in want.description], r)) for r in want.fetchall()]
    out = QUERIES[name](spark, SMALL)
    assert sorted(out.columns) == columns
    mine = [tuple(_plain(r[c]) for c in columns) for r in out.collect()]
    assert ordered(mine) == ordered([tuple(_plain(r[c]) for c in columns) for r in rows])


def test_frequent_pre_tokens_come_from_all_over_the_table(spark):
    """Words of a source that stands last are found, however the rows are ordered; the limit holds."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from transitlens.llm import token_counts

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = spark.range(0, 30_000, 1, 6).select(
        F.col("id").alias("key"), F.when(F.col("id") < 25_000, "first words here").otherwise("zebra quagga okapi").alias("text"))
    got = token_counts.frequent_lengths(rows, path)
    assert set(got) == set("first words here zebra quagga okapi".split())
    assert all(n == len(token_counts.model(path).encode(u)) for u, n in got.items())
    odd = spark.createDataFrame([(1, ""), (2, "\nzebra zebra"), (3, "  "), (4, "x" * 100 + " x x")], "key long, text string")
    assert set(token_counts.frequent_lengths(odd, path)) == {"x"}
    assert token_counts.frequent_lengths(odd.limit(0), path) == {}
