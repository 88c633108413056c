"""Global places without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lineage import cut


def placed(df: DataFrame, key: Column, ties: list[Column], buckets: int = 64, name: str = "place") -> DataFrame:
    """``df`` with the 1-based place of each row in ascending order of the numeric ``key``, then of ``ties``.

    Approximate quantiles cut the key into ranges; rows are numbered within their range and moved up by the counts of
    the ranges below, so no task sees more than a range. Null keys come last. Rows equal in key and ties may swap places.
    """
    held = cut(df.withColumn("__key", key.cast("double")))
    cuts = sorted(set(held.approxQuantile("__key", [i / buckets for i in range(1, buckets)], 0.005))) if buckets > 1 else []
    held = held.withColumn("__range", F.when(F.col("__key").isNull(), len(cuts) + 1).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c < F.col("__key")))))
    counts = {r["__range"]: r["count"] for r in held.groupBy("__range").count().collect()}
    below, steps = 0, []
    for r in sorted(counts):
        steps += [F.lit(r), F.lit(below)]
        below += counts[r]
    place = F.row_number().over(Window.partitionBy("__range").orderBy(F.col("__key"), *ties))
    offset = F.element_at(F.create_map(*steps), F.col("__range")) if steps else F.lit(0)
    return held.withColumn(name, (place + offset).cast("long")).drop("__key", "__range")
