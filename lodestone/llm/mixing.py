"""Mixing sources to target weights by Sainte-Laguë apportionment.

Each source's words are dealt to shards by a hash of the document. All shards compete for
equal blocks of words by the quotients target / (2 k + 1); the highest win, which gives each
shard an integer quota. A shard's documents stand in a seeded order and are cut into its
blocks; the quota takes all blocks as often as it can and then some of them, spread evenly
from a seeded start. Block choice is arithmetic, so no block ever becomes a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.order import placed as in_order
from .work import drop, pick, sized, store

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
#: Words of a block (fewer where the whole corpus has under BLOCK * 65536 words, so that small ones still have many blocks) and of a shard.
BLOCK, SHARD = 64, 2_000_000


def targets(sizes: DataFrame) -> DataFrame:
    """(source, size) -> source, source_size, target: the share of all words, by weight, none above CAP times its source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = named.withColumn("weight", F.element_at(weights, ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int")).cast("double"))
    named = named.withColumn("limit", (CAP * F.col("source_size")).cast("double"))
    # sources fill up in order of limit / weight; the level at which the rest share what is left
    # rises until a source stays below its limit, and sinks from there
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy((F.col("limit") / F.col("weight")).desc(), F.col("source").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    named = named.withColumn("level", (SHARE * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(filled), F.lit(0.0))) / F.sum("weight").over(rest))
    named = named.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(whole))
    return named.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least("limit", F.col("level") * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, seed: int = 17) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, source.

    ``size`` counts words between ASCII white space (null: 0); ``taken`` is how many of them the
    mix takes, repeats counted, at most 2 * size. A null source is a source. Rows of equal id
    and text may swap their taken counts; otherwise reruns agree. Empty texts take 0, an empty
    table gives no rows. Further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(*pick(docs, "doc_id", "text", "source"))
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sizes, sizes_path = store(docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    aims, aims_path = store(targets(sizes), "targets")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    block = max(1, min(BLOCK, total // 65536))
    parts = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD)).cast("long")
    dealt = sizes.join(sized(aims, limit=100_000), sizes["source"].eqNullSafe(aims["source"])).select("doc_id", sizes["source"], "size", "text_hash", "source_size", "target")
    # null ids are dealt by their texts
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")), F.lit(seed)), parts))
    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("aim"))
    shards = shards.where("words > 0").withColumn("aim", F.col("aim") * F.col("words") / F.col("source_size"))
    shards, shards_path = store(shards, "shards")
    n, aim = shards.agg(F.count("*"), F.sum("aim")).first()
    house = int(round((aim or 0.0) / block))
    # each shard sends the quotients around its share that may still win or lose; those below win anyway
    near = F.col("aim") / block
    width = F.ceil(near * (n or 0) / max(2 * house, 1)) + 2
    bids = shards.withColumn("low", F.greatest(F.lit(0), F.floor(near - width))).withColumn("high", F.least(F.ceil(near + width), CAP * F.ceil(F.col("words") / block)))
    sure = bids.agg(F.sum("low")).first()[0] or 0
    bids = bids.where("high > low").select("source", "shard", "aim", F.explode(F.expr("sequence(low, high - 1)")).alias("k"))
    # places by quotient without a window over all bids
    best = in_order(bids, -(F.col("aim") / (2 * F.col("k") + 1)), [F.col("source").asc_nulls_last(), F.col("shard"), F.col("k")])
    won = best.where(F.col("place") <= house - sure).groupBy("source", "shard").agg(F.count("*").alias("won"))
    won = won.withColumnsRenamed({"source": "s", "shard": "h"})
    quota = shards.join(won, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")), "left")
    quota = quota.select(F.col("source").alias("s"), F.col("shard").alias("h"), "words", (F.greatest(F.lit(0), F.floor(near - width)) + F.coalesce("won", F.lit(0))).cast("long").alias("quota"))
    quota, quota_path = store(quota, "quota")
    stand = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), "doc_id", "size", "text_hash"), "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("b", F.sum("size").over(stand))
    placed = placed.join(sized(quota, limit=100_000), F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")), "left")
    placed = placed.withColumns({"a": F.col("b") - F.col("size"), "n": F.ceil(F.col("words") / block).cast("long")})
    placed = placed.withColumns({"m": F.expr("quota % n"), "passes": F.expr("quota div n"), "u": F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), "shard"), F.col("n"))})
    # selected blocks among the first j: floor((j + u) m / n) - floor(u m / n); words of them up to word x
    chosen = lambda j: f"(({j} + u) * m div n)"
    upto = lambda x: f"(({chosen(f'({x} div {block})')} - (u * m div n)) * {block} + ({chosen(f'({x} div {block} + 1)')} - {chosen(f'({x} div {block})')}) * ({x} % {block}))"
    extra = F.expr(f"{upto('b')} - {upto('a')}")
    out = placed.select("doc_id", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("passes") * F.col("size") + extra).otherwise(0).cast("long").alias("taken"), "source")
    final, _ = store(out, "mix")
    drop(spark, sizes_path, aims_path, shards_path, quota_path)
    return final
