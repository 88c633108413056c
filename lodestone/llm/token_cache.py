"""Token counts through a digest cache.

A text's key is the digest of its content and of the tokenizer's version (its file and the
library). Stored counts are joined by key; only distinct texts without a count are encoded,
and their counts are appended to the cache. Pieces between blanks or line feeds are encoded
apart, which the tokenizer's splitting at white space allows, and counted from a bounded
memo of pieces.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import fresh_path, pick, sized, store

#: Pieces that one worker remembers.
MEMO = 400_000
_SCHEMA = "digest binary, version string, n_tokens long"


def version_of(path: str) -> str:
    import tokenizers

    with open(path, "rb") as f:
        return f"tokenizers-{tokenizers.__version__}-{hashlib.sha256(f.read()).hexdigest()}"


class Counter:
    """Counts of whole texts by a tokenizer that splits at white space and drops it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.memo = Tokenizer.from_file(path), {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __call__(self, texts: list[str]) -> list[int]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        new = list({p for s in split for p in s} - self.memo.keys())
        if len(self.memo) + len(new) > MEMO:
            self.memo = {}
            new = list({p for s in split for p in s})
        for a in range(0, len(new), 5000):
            part = new[a : a + 5000]
            self.memo.update(zip(part, (len(e) for e in self.tokenizer.encode_batch(part, add_special_tokens=False)), strict=True))
        get = self.memo.__getitem__
        return [sum(map(get, s)) for s in split]


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``tokenizer`` is the path of a tokenizer file on every machine; ``cache`` a folder of the
    store, kept between runs (a fresh one if not given). The query takes the folder that the session
    names in spark.lodestone.tokenCache. Null counts as empty. Repeated texts
    are encoded once. No begin, end or special tokens are added; no truncation. An empty table
    gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    cache, version = cache or fresh_path(spark, "token-cache"), version_of(tokenizer)
    texts = docs.select(*pick(docs, "doc_id", "text")).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("digest"))
    keys, _ = store(keyed, "digests")
    own, _ = store(keys.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "distinct")
    spark.createDataFrame([], _SCHEMA).write.mode("append").parquet(cache)
    known = spark.read.schema(_SCHEMA).parquet(cache).where(F.col("version") == version).select("digest", "n_tokens").dropDuplicates(["digest"])
    missing, _ = store(own.join(known, "digest", "left_anti").select("digest", "first"), "missing")
    by_id = texts.join(sized(missing.where("first is not null").select(F.col("first").alias("doc_id")).distinct()), "doc_id", "left_semi").select("text")
    # texts that only null ids have are known by their digests
    nameless = texts.where("doc_id is null").select("text", F.unhex(F.sha2("text", 256)).alias("digest")).join(missing.where("first is null").select("digest"), "digest", "left_semi").select("text")
    wanted = by_id.unionByName(nameless.distinct())

    def run(batches):
        count = Counter(tokenizer)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                own = batch.slice(a, 256).column("text").to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(t.encode()).digest() for t in own], pa.binary()), pa.array(count(own), pa.int64())], ["digest", "n_tokens"])

    fresh = wanted.mapInArrow(run, "digest binary, n_tokens long").join(missing.select("digest"), "digest", "left_semi")
    fresh.select("digest", F.lit(version).alias("version"), "n_tokens").dropDuplicates(["digest"]).write.mode("append").parquet(cache)
    counts = spark.read.schema(_SCHEMA).parquet(cache).where(F.col("version") == version).select("digest", "n_tokens").dropDuplicates(["digest"])
    # a digest of over a thousandth of the rows (at most a thousand are) is joined by broadcast: its copies stay where they are
    often = own.where(F.col("copies") * 1000 > keys.count()).select("digest")
    hot = F.broadcast(counts.join(F.broadcast(often), "digest"))
    rest = keys.join(F.broadcast(often), "digest", "left_anti").join(counts, "digest", "left")
    told = keys.join(hot, "digest").unionByName(rest)
    return told.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
