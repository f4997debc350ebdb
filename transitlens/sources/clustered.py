"""Tables clustered by a key: hash buckets in a folder of their own, read without an exchange.

A join, window or aggregation over the key of such a table finds its rows
together: Spark reads bucket by bucket and shuffles nothing. The folder holds
plain Parquet (by date folders, if partitioned) and a note of its buckets; the
session's catalog gets an external table over it when it is first opened, so a
new session, or another one, finds the same clustering. The catalog's name of
it is made from the path.

A key is never split over buckets. Keys that hold a large share of all rows
belong into a plain table beside it (see sources.journeys).
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.session import settings
from transitlens.sources.files import delete, hadoop, move, names, read_text, write_text

NOTE = "_clustered"
CONF_BUCKETS = "spark.transitlens.buckets"
CODEC = "zstd"           # a third smaller than snappy for journeys dealt by date, whose texts hardly repeat within a file


def default_buckets(spark: SparkSession) -> int:
    """Buckets of a new table: the setting, else the session's shuffle partitions (at most 4,096: a date has a file for each)."""
    return int(spark.conf.get(CONF_BUCKETS, "") or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4_096))


def table_name(path: str) -> str:
    return "transitlens_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()[:20]


def is_clustered(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, f"{path}/{NOTE}")
    return fs.exists(p)


def create(spark: SparkSession, path: str, schema: T.StructType, key: str, sort: list[str],
           partition_by: str | None = None, buckets: int | None = None) -> None:
    """Note how a (new) folder is clustered. The note holds for the folder's life."""
    note = {"key": key, "sort": sort, "partition_by": partition_by, "buckets": buckets or default_buckets(spark), "schema": schema.json()}
    write_text(spark, f"{path}/{NOTE}", json.dumps(note))


def buckets(spark: SparkSession, path: str) -> int:
    """The buckets of the table at ``path``, of a new one if there is none."""
    return json.loads(read_text(spark, f"{path}/{NOTE}"))["buckets"] if is_clustered(spark, path) else default_buckets(spark)


def _register(spark: SparkSession, path: str) -> tuple[str, dict]:
    """The catalog table over the folder, made where the session hasn't got it."""
    note, name = json.loads(read_text(spark, f"{path}/{NOTE}")), table_name(path)
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(note["schema"])))
        by = f"PARTITIONED BY (`{note['partition_by']}`)" if note["partition_by"] else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet {by} CLUSTERED BY (`{note['key']}`) "
                  f"SORTED BY ({', '.join(f'`{c}`' for c in note['sort'])}) INTO {note['buckets']} BUCKETS LOCATION '{path}'")
    return name, note


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table over a clustered folder as it is now."""
    name, note = _register(spark, path)
    if note["partition_by"]:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def write(df: DataFrame, path: str, key: str, sort: list[str], buckets: int | None = None, partition_by: str | None = None) -> None:
    """A new folder, by date folders if partitioned; its session table is dropped again (open it with :func:`read`, there or where it is moved to)."""
    spark = df.sparkSession
    n, name = buckets or default_buckets(spark), table_name(path)
    out = df.repartition(n, key).write.mode("overwrite").option("compression", CODEC).option("path", path)
    out = out.partitionBy(partition_by) if partition_by else out
    out.bucketBy(n, key).sortBy(*sort).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    create(spark, path, partitioned(df.schema, partition_by), key, sort, partition_by, n)


def partitioned(schema: T.StructType, by: str | None) -> T.StructType:
    """The schema with the partition column at its end."""
    return schema if by is None else T.StructType([*[f for f in schema if f.name != by], schema[by]])


def replace_partitions(df: DataFrame, path: str, at: str | None = None) -> None:
    """Overwrite the partitions that ``df`` has rows of, a file for each of its buckets; others stay.

    ``at`` is the folder of ``df``, if that is a table of :func:`write` with the
    same partitions and buckets: its partitions are moved, not written again.
    A call that broke off is finished by another one.
    """
    spark = df.sparkSession
    if at is not None:
        for part in (n for n in names(spark, at) if "=" in n):
            delete(spark, f"{path}/{part}")
            move(spark, f"{at}/{part}", f"{path}/{part}")
        return
    name, note = _register(spark, path)
    columns = [c for c in spark.table(name).columns]
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.parquet.compression.codec": CODEC}):
        df.select(*[F.col(c) for c in columns]).repartition(note["buckets"], note["key"]).write.mode("overwrite").insertInto(name)


def add_partitions(spark: SparkSession, at: str, path: str) -> None:
    """Move the files of a partitioned folder of :func:`write` into the partitions of another one with the same buckets."""
    for part in (n for n in names(spark, at) if "=" in n):
        for file in names(spark, f"{at}/{part}"):
            move(spark, f"{at}/{part}/{file}", f"{path}/{part}/{file}")


def drop(spark: SparkSession, path: str) -> None:
    """Remove the folder and the session's table over it."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
    delete(spark, path)
