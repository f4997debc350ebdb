"""Incremental file intake with Structured Streaming (S12): into a table, or on into silver and gold.

A file stream with a checkpoint remembers which files it has already
loaded, so running the same intake again (a retry, the next day's run) only
takes files that arrived since; ``availableNow`` processes everything
present and stops, which fits a daily batch schedule. Each micro-batch goes to
a folder of its own, named by the stream and the batch's number: a batch that
is repeated after a stop overwrites what it wrote before, so nothing is lost or
counted twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.plans import daily
from transitlens.session import tidy_shuffles
from transitlens.sources.files import delete, hadoop, listed, read_text
from transitlens.sources.journeys import forget_landing, index_landing
from transitlens.sources.json_records import LINEAGE, by_keys, records
from transitlens.sources.readers import by_name, enforce_schema


def _stream(spark: SparkSession, source: str, fmt: str, pattern: str | None, max_files: int | None) -> DataFrame:
    """The files of a folder as a stream of raw rows with their lineage; JSON as pieces of text."""
    def options(r):
        r = r.option("recursiveFileLookup", "true")
        return r.option("pathGlobFilter", pattern) if pattern else r

    r, batch = options(spark.readStream), options(spark.read)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    lineage = [F.col(f"_metadata.{c}").alias(c) for c in LINEAGE]
    if fmt == "csv":
        header = batch.option("header", "true").csv(source).columns
        raw = r.option("header", "true").option("enforceSchema", "false").schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(source)
    elif fmt == "json":
        raw = r.option("lineSep", "}").text(source)
        lineage += [F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_size").alias("_size")]
    elif fmt == "parquet":
        raw = r.schema(batch.parquet(source).schema).parquet(source)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return raw.select("*", *lineage)


def _rows(batch: DataFrame, fmt: str, schema: T.StructType) -> DataFrame:
    """A micro-batch as the schema's columns, as in the batch readers: found by case-insensitive name."""
    if fmt == "json":
        return by_keys(records(batch.withColumn("_at", F.monotonically_increasing_id())), schema)
    return by_name(batch, schema)


def _run(stream: DataFrame, checkpoint: str, take) -> list[int]:
    """Give every new micro-batch to ``take(batch, name, number)``; the numbers of those that are committed since."""
    spark = stream.sparkSession
    before = _batches(spark, checkpoint)

    def sink(batch: DataFrame, number: int) -> None:
        take(batch, json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"], number)

    q = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    return sorted(_batches(spark, checkpoint) - before)


def ingest_incremental(spark: SparkSession, source: str, target: str, checkpoint: str,
                       schema: T.StructType, fmt: str = "parquet", pattern: str | None = None,
                       max_files_per_trigger: int | None = None) -> dict:
    """Add the not-yet-loaded files under ``source`` to the Parquet table ``target``.

    Columns are matched by case-insensitive name as in the batch readers: CSV
    by the header (one for all files, else the load fails), JSON of any layout
    by the keys of each record, Parquet by the files' own columns. Values are
    typed with try_cast, rejected rows are kept with ``_rejected`` and their
    reason, and the source file path is kept for lineage; ``batch_id`` is the
    table's partition. Returns the rows that this run added to the target and
    its micro-batches.
    """
    def folder(stream: str, number: int) -> str:
        return f"{target}/batch_id={stream}-{number}"

    def take(batch: DataFrame, stream: str, number: int) -> None:
        typed = enforce_schema(_rows(batch, fmt, schema), schema, keep_extra=True)
        typed.select(*[f.name for f in schema.fields], "file_path", "_rejected", "_reject_reason") \
            .write.mode("overwrite").parquet(folder(stream, number))

    done = _run(_stream(spark, source, fmt, pattern, max_files_per_trigger), checkpoint, take)
    if not done:
        return {"rows": 0, "batches": 0}
    stream = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
    added = spark.read.option("basePath", target).parquet(*[folder(stream, n) for n in done])
    return {"rows": added.count(), "batches": len(done)}


def feed_lake(spark: SparkSession, source: str, lake_root: str, dataset: str, checkpoint: str, fmt: str = "parquet",
              pattern: str | None = None, max_files_per_trigger: int | None = None, hot_keys: list | str | None = None) -> dict:
    """Take the new files of a dataset (shipments or scans) into bronze, and bring their journeys up to date in silver and gold.

    A micro-batch is a bronze folder of its own. The journeys that it names
    are rebuilt from all of bronze, daily landings included, and replaced as a
    daily run does; the result is that of a daily run over the same rows. A
    repeated batch changes nothing. Hub masters are landed by daily runs or
    ``daily.land_rows``. Returns the rows taken in and the micro-batches.
    """
    lake, schema = lake_root.rstrip("/"), daily.DATASETS[dataset][1]
    name = daily.intake(dataset)
    if dataset not in daily.JOURNEYS:
        raise ValueError(f"{dataset} has no journeys")

    def take(batch: DataFrame, stream: str, number: int) -> None:
        ds = f"{stream}-{number}"
        work, target = f"{lake}/_work/{dataset}-{ds}", f"{lake}/bronze/{name}/ingest_date={ds}"
        with tidy_shuffles(spark):
            daily.recover(spark, lake)
            daily.intend(spark, lake, ds, work, [name])
            forget_landing(spark, lake, name, ds)
            rows = _rows(batch, fmt, schema)
            rows.withColumns({f.name: F.col(f.name).cast("string") for f in schema.fields}).write.mode("overwrite").parquet(target)
            index_landing(daily.bronze(spark, lake, name, dates=[ds]), lake, name, ds)
            daily.intend(spark, lake, ds, work, [name])
            daily.update_journeys(spark, lake, daily.intended(spark, work), work, hot_keys)
            daily.publish(spark, lake, daily.recover(spark, lake))
            delete(spark, work)

    done = _run(_stream(spark, source, fmt, pattern, max_files_per_trigger), checkpoint, take)
    if not done:
        return {"rows": 0, "batches": 0}
    stream = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
    return {"rows": daily.bronze(spark, lake, name, dates=[f"{stream}-{n}" for n in done]).count(), "batches": len(done)}


def _batches(spark: SparkSession, checkpoint: str) -> set[int]:
    """The numbers of the committed micro-batches of a checkpoint."""
    if not listed(spark, f"{checkpoint}/commits"):
        return set()
    fs, p = hadoop(spark, f"{checkpoint}/commits")
    return {int(n) for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.isdigit()}
