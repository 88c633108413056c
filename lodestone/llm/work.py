"""Shared work folder: tables that cut lineage and that every executor can read.

The folder is the one the session names in ``spark.checkpoint.dir``. Only where the
session names none (tests, one machine) a folder of our own is set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys up to this many rows may be broadcast (8 bytes each, so about 16 MB); beyond it the same join shuffles.
BROADCAST_KEYS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own is set only on one machine, if there is none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(named)
    # by the store's full name: a path without a scheme is one of Hadoop's default file system, not of a machine's disk
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(named)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lodestone/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; returns the table read again and its path."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove work tables that no later read needs."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sized(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_KEYS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay within ``limit``, else as it is (the join then shuffles)."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def pick(df: DataFrame, *names: str) -> list[Column]:
    """Columns by exact name, so that further columns of the input, whatever their names, stay out."""
    return [df[f"`{n}`"].alias(n) for n in names]
