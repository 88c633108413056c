"""Source audits and state over Structured Streaming; the same operators as in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.curation import raised_baseline, source_health
from ..sources.sinks import load_state


def health(events: DataFrame, source: str, status: str, records: Column) -> DataFrame:
    """Health of each source so far (update or complete mode): the batch operator, which is one grouped aggregate."""
    return source_health(events, source, status, records)


def windowed(events: DataFrame, time: str, keys: list[str], late: str = "1 day", width: str = "7 days", origin: str = "0 days") -> DataFrame:
    """Counts by reporting window and key. Events later than ``late`` behind the newest are dropped, as the watermark says;
    windows are given out (append mode) once it has passed them."""
    return events.withWatermark(time, late).groupBy(F.window(time, width, width, origin).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def baseline_sink(path: str, keys: list[str], value: str, schema: str):
    """A foreachBatch function that keeps the largest value of each key in a table of versions, one a batch; a batch that
    runs again writes its own version anew."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = load_state(spark, f"{path}/v{number - 1}", schema) if number else spark.createDataFrame([], schema)
        raised_baseline(old, batch.groupBy(*keys).agg(F.max(value).alias(value)), keys, value).write.mode("overwrite").parquet(f"{path}/v{number}")

    return run
