"""Lineage cut by tables in the folder that the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table under spark.checkpoint.dir and read again, so that it is computed once and lost
    executors cost a read. Only a session on one machine that names no folder gets one of its own. The table stays there."""
    spark = df.sparkSession
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lodestone-")
        context.setCheckpointDir(named)
    path = f"{named.rstrip('/')}/lodestone/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
