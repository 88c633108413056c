"""Sinks: tables as JSON, issues with their history index, capped state. Every write goes to a path that Spark resolves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_json(df: DataFrame, path: str) -> None:
    """The table as JSON lines, in place of what was there."""
    df.write.mode("overwrite").json(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_audits(audits: dict[str, DataFrame], path: str, issue_id: str) -> None:
    """One table for each audit, partitioned by issue; an issue written again replaces its own partition."""
    for name, df in audits.items():
        df.withColumn("issue_id", F.lit(issue_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue_id").parquet(f"{path}/{name}")


def upserted_index(index: DataFrame, new: DataFrame, most: int = 365) -> DataFrame:
    """History (issue_date, issue_id, profile_id) with new issues first, one a date, the newest ``most`` (its capacity)."""
    kept = index.join(new.select("issue_date"), "issue_date", "left_anti")
    return new.dropDuplicates(["issue_date"]).unionByName(kept).orderBy(F.col("issue_date").desc()).limit(most)


def write_issue(issue: DataFrame, path: str) -> None:
    """An issue (one row with issue_date, issue_id, profile_id, ...) as the latest, in the history by date, and in the index.

    The index is written beside the old one and then moved into its place."""
    spark = issue.sparkSession
    key = issue.select("issue_date", "issue_id", "profile_id")
    write_json(issue, f"{path}/latest")
    issue.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue_date").json(f"{path}/history")
    index = f"{path}/history_index"
    schema = "issue_date string, issue_id string, profile_id string"
    old = spark.read.schema(schema).json(index) if exists(spark, index) else spark.createDataFrame([], schema)
    replace(upserted_index(old, key.select(*(F.col(c).cast("string") for c in key.columns))), index)


def replace(df: DataFrame, path: str) -> None:
    """A JSON table written beside its old version, which it then replaces."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new = f"{path}.new"
    df.coalesce(1).write.mode("overwrite").json(new)
    a, b = jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(path)
    fs = b.getFileSystem(conf)
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"{new} could not be moved to {path}")


def load_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table; empty where there is none."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def capped_cache(cache: DataFrame, key: str, seq: str, most: int = 5000) -> DataFrame:
    """The latest entry of each key, and of those the latest ``most`` (a cache's capacity)."""
    latest = cache.groupBy(key).agg(F.max_by(F.struct(*[c for c in cache.columns if c != key]), seq).alias("x")).select(key, "x.*")
    return latest.orderBy(F.col(seq).desc(), key).limit(most)
