"""The thin queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, media, mixing, ngram_join, notices, pii, quality, token_cache, toxicity, warc
from .sql import ORACLES


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda s, d: _read(s, d, "documents")
    return {
        "op1_mixing": lambda s, d: mixing.mix(docs(s, d)),
        "op2_media": lambda s, d: media.payloads(docs(s, d)),
        "op3_warc": lambda s, d: warc.archived(_read(s, d, "pages")),
        "op4_token_counts": lambda s, d: token_cache.token_counts(docs(s, d), tokenizer_path(), s.conf.get("spark.lodestone.tokenCache", None)),
        "op5_quality": lambda s, d: quality.quality(docs(s, d), _read(s, d, "labels")),
        "op6_decontamination": lambda s, d: decontaminate.contamination(docs(s, d), _read(s, d, "benchmark")).drop("text_hash"),
        "op7_toxicity": lambda s, d: toxicity.toxicity(docs(s, d), _read(s, d, "labels")),
        "op8_licenses": lambda s, d: notices.scan(docs(s, d)),
        "op9_personal_data": lambda s, d: pii.personal_data(docs(s, d)),
        "op10_ngram_join": lambda s, d: ngram_join.jaccard_components(docs(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
