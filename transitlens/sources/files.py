"""Small things done to a lake's folders through Hadoop's file system API, whatever store they lie in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The file system and the path object of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, without hidden files; nothing if there is no folder."""
    fs, p = hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if not n.startswith(("_", ".")))


def listed(spark: SparkSession, path: str) -> bool:
    """Whether a table is there: a folder with partitions or data files."""
    return bool(names(spark, path))


def written(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing a table."""
    fs, p = hadoop(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder; nothing may lie at ``target``."""
    fs, p = hadoop(spark, path)
    _, t = hadoop(spark, target)
    fs.mkdirs(t.getParent())
    if fs.exists(t) or not fs.rename(p, t):
        raise OSError(f"could not move {path} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = hadoop(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
