"""Intermediate tables of the operators, in the shared checkpoint folder.

Every multi-pass operator cuts its lineage by writing a Parquet table under
``spark.checkpoint.dir`` and reading it back, so a lost executor costs its
running tasks and no earlier pass.
"""

from __future__ import annotations

import gc
import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from transitlens.llm.shared_files import new_file, open_fs
from transitlens.session import checkpoint_dir


class Scratch:
    """A folder of its own for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens-llm/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(self.path(table))
        # shuffle files of finished passes go when the JVM collects what refers to them
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, table: str) -> None:
        """Delete a table that no returned frame reads any more."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(table))
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def parallelism(spark: SparkSession) -> int:
    """The session's shuffle partitions: the number of buckets that hand-dealt exchanges use."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranges_for(spark: SparkSession, text_bytes: int | None) -> int:
    """How many ranges work on so much text is dealt to: the session's partitions, or more if those would be too large."""
    return max(parallelism(spark), -(-(text_bytes or 0) // RANGE_BYTES))


RANGE_BYTES = 64 << 20   # text that one task of an exchange answers for, at most about
_SHIPPED: set[str] = set()
BATCH_ROWS = 2_000       # rows of an Arrow batch at most: they hold whole texts


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's source, once per application, by way of the shared folder.

    Python tasks import the package; on a cluster it need not be installed.
    Arrow batches are kept small, so that a Python worker holds few texts at a time.
    """
    sc, key = spark.sparkContext, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, f"{package.name}/{p.relative_to(package)}")
    uri = new_file(f"{checkpoint_dir(spark).rstrip('/')}/transitlens-llm", ".zip")
    f, path = open_fs(uri)
    with f.open_output_stream(path, compression=None) as out:
        out.write(raw.getvalue())
    sc.addPyFile(uri)
    _SHIPPED.add(sc.applicationId)
