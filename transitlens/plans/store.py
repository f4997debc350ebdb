"""Materialized layers in the shared checkpoint folder.

The silver table is the reference's hand-off between layers: built once per
input version, written as Parquet, and read by every gold query. Here it is
stored under ``spark.checkpoint.dir`` (shared storage on a cluster), keyed by
a fingerprint of the input files (path, size, modification time), so a change
of input produces a new folder and a stale table is never read. Writing the
table also cuts the lineage: gold queries and retries of lost executors
restart from the Parquet files, not from the raw joins and windows.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from transitlens.session import checkpoint_dir, tidy_shuffles
from transitlens.sources import clustered

_LOCK = threading.RLock()
CONF_ENABLED = "spark.transitlens.materialize"
# Optional sub-folder of the store, e.g. one per benchmark run so nothing is reused.
CONF_NAMESPACE = "spark.transitlens.store.namespace"


def _code_version() -> str:
    """Hash of this package's source: a stored layer is only reused by the code that built it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for d, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def enabled(spark: SparkSession) -> bool:
    return str(spark.conf.get(CONF_ENABLED, "true")).lower() == "true"


def namespace(spark: SparkSession) -> str:
    """The store's sub-folder: by default one per application.

    So no result comes from files of an earlier session, and two drivers never
    build or replace each other's tables. Set ``CONF_NAMESPACE`` to share.
    """
    return spark.conf.get(CONF_NAMESPACE, "") or spark.sparkContext.applicationId


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, paths: list[str], *extra: str) -> str:
    """Stable key over (path, length, mtime) of every input file."""
    h = hashlib.sha256(CODE_VERSION.encode())
    for path in paths:
        fs, p = _fs(spark, path)
        for st in fs.listStatus(p) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]:
            h.update(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()};".encode())
    for e in extra:
        h.update(e.encode())
    return h.hexdigest()[:20]


def materialize(spark: SparkSession, build, layer: str, key: str,
                cluster: tuple[str, list[str]] | None = None) -> DataFrame:
    """Write ``build()`` once to <checkpoint>/transitlens/<layer>/<key>; read it back.

    ``build`` is a DataFrame or a zero-argument callable returning one; the
    callable is only invoked (and its plan only constructed) when the layer
    is not stored yet. ``cluster`` (key, sort columns) stores it in hash
    buckets of the key, so that joins and windows over the key read it without
    an exchange.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/transitlens/{namespace(spark)}/{layer}/{key}"
    with _LOCK:
        fs, p = _fs(spark, root)
        if not fs.exists(_fs(spark, root + "/_SUCCESS")[1]):
            df = build() if callable(build) else build
            tmp = f"{root}.tmp-{uuid.uuid4().hex[:8]}"
            with tidy_shuffles(spark):
                if cluster:
                    clustered.write(df, tmp, *cluster)
                else:
                    df.write.mode("overwrite").option("compression", "snappy").parquet(tmp)
            tfs, tp = _fs(spark, tmp)
            fs.mkdirs(p.getParent())
            # a table is moved as a whole and never replaced: if another thread or driver was first, its table holds
            if fs.exists(p) or not tfs.rename(tp, p):
                tfs.delete(tp, True)
                if not fs.exists(_fs(spark, root + "/_SUCCESS")[1]):
                    raise OSError(f"could not move {tmp} to {root}")
    return clustered.read(spark, root) if cluster else spark.read.parquet(root)
