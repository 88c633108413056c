"""All queries of the engine's own operators, by operator id, with their oracle SQL.

Each query runs an operator over whole driver tables, seen through a lens that derives the
operator's fields from them. The SQL states the same semantics for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import ranking, relevance
from . import completing, gating, landing, merging, packing, publish, scalars  # noqa: F401
from .registry import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, detect the language, assess, score and rank; the best 25, at most four of a source."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    d = relevance.assessed(d, F.left("text", F.lit(80)), F.substring("text", 81, 1 << 30), gating.TOPIC, "x")
    x = F.col("x")
    listed = F.array("source")
    quality = ranking.paper_quality(relevance.normalised(x["score"]), listed, F.array("lang"), F.lit(""), F.col("text"), text.EMPTY(), F.lit(False), F.lit(""), F.lit(0), F.lit(""), F.current_date())
    d = d.select("doc_id", "source", "n_chars", text.detect_language(F.col("text"), F.col("lang")).alias("language"), x["score"].alias("score"), x["decision"].alias("decision"), quality.alias("quality"))
    return ranking.diversified_top(d.where("decision <> 'reject'"), [F.col("quality").desc(), F.col("doc_id")], "source", 25, 4, 15)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
