"""Paths on the cluster's file system, through Hadoop's client."""

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    path, fs = _fs(spark, pattern)
    return [str(status.getPath().toString()) for status in fs.globStatus(path) or []]


def modified(spark: SparkSession, pattern: str) -> dict[str, float]:
    """Paths and when they were last changed, in seconds."""
    path, fs = _fs(spark, pattern)
    found = fs.globStatus(path) or []
    return {str(s.getPath().toString()): s.getModificationTime() / 1000 for s in found}


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _fs(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears as a whole or not at all; its name must be new."""
    hadoop_path, fs = _fs(spark, path)
    if fs.exists(hadoop_path):
        raise FileExistsError(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, hadoop_path):
        fs.delete(draft, False)
        raise FileExistsError(path)


def publish_folder(df: DataFrame, path: str, replace: bool = False) -> bool:
    """Write `df` as parquet to a folder that appears as a whole; one that is there stays as it is, or is replaced."""
    spark = df.sparkSession
    hadoop_path, fs = _fs(spark, path)
    if fs.exists(hadoop_path) and not replace:
        return False
    parent = hadoop_path.getParent()
    draft = spark._jvm.org.apache.hadoop.fs.Path(parent.getParent(), f".{parent.getName()}-{uuid.uuid4().hex}")
    df.write.parquet(str(draft.toString()))
    fs.mkdirs(parent)
    if replace:
        fs.delete(hadoop_path, True)
    if not fs.rename(draft, hadoop_path):
        fs.delete(draft, True)
        raise FileExistsError(path)
    return True


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="keyedflow-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below `spark.checkpoint.dir`, which all executors can reach.

    A cluster sets it. Where it is unset, as on a single machine, it is one temporary folder; on a cluster that is an error,
    because executors do not share such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
