"""Benchmark decontamination by winnowing, in DataFrame functions only.

A fingerprint is the hash of ``GRAM`` consecutive words; of every ``SPAN`` consecutive ones
the smallest is kept. Two texts that share GRAM + SPAN - 1 = 13 words therefore keep a common
fingerprint inside them, whatever stands around. Fingerprints of texts and benchmark are
joined, and each hit is extended word by word along its diagonal (place in the text less
place in the item), so that results rest on the words, not on hashes.

An item in which a fingerprint stands often (one word or phrase over and over) would meet a text as repetitive in
places times places; its distinct windows are sought in the texts that share a fingerprint, word by word.

Items of fewer than 13 words are whole windows. Those of GRAM words or more are sought by
their smallest fingerprint among all fingerprints of a text, shorter ones by their smallest
word hash; both only if the benchmark has such items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .work import drop, pick, sized, store

WINDOW = 13
GRAM = 5
SPAN = WINDOW - GRAM + 1
#: Items in which a fingerprint stands more often than this are compared window by window.
REPEATS = 16
#: Items are broadcast while their words together stay below this many characters.
BROADCAST_CHARS = 16_000_000
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; inlined into a lambda it would be computed for each element."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, SMALL)
    return F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def grams(words: Column) -> Column:
    return F.when(F.size(words) >= GRAM, F.transform(F.sequence(F.lit(1), F.size(words) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(words, i, GRAM)))).otherwise(F.array().cast("array<long>"))


def winnow(hashes: Column) -> Column:
    """The smallest of every SPAN consecutive hashes."""
    return F.when(F.size(hashes) >= SPAN, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(hashes) - (SPAN - 1)), lambda i: F.array_min(F.slice(hashes, i, SPAN))))).otherwise(F.array().cast("array<long>"))


def singles(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w, F.lit(1)))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text):
    doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and text_hash (with doc_id the row's key).

    n_hit counts the words inside any occurrence of a 13-word window of an item (of a whole
    item with fewer words). Null, empty and word-free texts have 0 words and no hits; items
    without words are ignored, items with a null item_id hit but are not listed. An empty
    benchmark hits nothing. Repeated rows get equal results. Further columns are ignored.
    """
    docs = docs.select(*pick(docs, "doc_id", "text"))
    items = benchmark.select(*pick(benchmark, "item_id", "text")).select("item_id", word_list(F.col("text")).alias("iw")).where("size(iw) > 0").distinct()
    items, items_path = store(items.select(F.xxhash64("iw", "item_id").alias("item"), "item_id", "iw"), "items")
    seen = items.agg(F.sum(F.expr("aggregate(iw, 0L, (a, w) -> a + length(w))")), F.max(F.expr(f"size(iw) >= {GRAM} and size(iw) < {WINDOW}")), F.max(F.expr(f"size(iw) < {GRAM}"))).collect()[0]
    chars, mid, tiny = seen[0] or 0, bool(seen[1]), bool(seen[2])
    long_ = F.size("iw") >= WINDOW
    hashes = F.when(F.size("iw") >= GRAM, grams(F.col("iw"))).otherwise(singles(F.col("iw")))
    place = items.select("item", let(hashes, lambda h: F.struct(h.alias("h"), F.when(long_, winnow(h)).otherwise(F.array(F.array_min(h))).alias("kept"))).alias("x"))
    place = place.select("item", "x.kept", F.posexplode("x.h").alias("q", "fp")).where("array_contains(kept, fp)").select("fp", "item", "q")
    place, place_path = store(place, "places")
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_list(F.col("text")).alias("words"))

    def marked(w: Column) -> Column:
        prints = F.array_distinct(grams(w)) if mid else let(grams(w), winnow)
        if tiny:
            prints = F.concat(prints, F.array_distinct(singles(w)))
        return F.struct(F.size(w).cast("long").alias("n_words"), prints.alias("prints"))

    table = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), let(word_list(F.col("text")), marked).alias("x"))
    table, _ = store(table.select("doc_id", "text_hash", "x.n_words", "x.prints"), "prints")
    marks = place.select("fp").distinct()
    near = table.select("doc_id", "text_hash", F.explode("prints").alias("fp")).join(sized(marks), "fp", "left_semi").select("doc_id", "text_hash").distinct()
    near, near_path = store(near, "near")
    renamed = {"doc_id": "d", "text_hash": "t"}
    key = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    full = words.join(sized(near.withColumnsRenamed(renamed)), key, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    full, full_path = store(full, "full")
    at = grams(F.col("words"))
    spots = full.select("doc_id", "text_hash", F.posexplode(at).alias("p", "fp"))
    if tiny:
        spots = spots.unionByName(full.select("doc_id", "text_hash", F.posexplode(singles(F.col("words"))).alias("p", "fp")))
    often = place.groupBy("item", "fp").agg(F.count("*").alias("n")).where(f"n > {REPEATS}").select("item").distinct()
    often, often_path = store(often, "often")
    repetitive = not often.isEmpty()
    if repetitive:
        place = place.join(often, "item", "left_anti")
    diagonals = spots.join(sized(place), "fp").select("doc_id", "text_hash", "item", (F.col("p") - F.col("q")).alias("shift")).distinct()
    listed = F.broadcast(items) if chars <= BROADCAST_CHARS else items
    lined = diagonals.join(full.withColumnsRenamed(renamed), key).drop("d", "t").join(listed, "item")
    lined = lined.withColumn("width", F.least(F.lit(WINDOW), F.size("iw")))
    # extension: which words agree along the diagonal, and where a whole window does
    same = F.expr("transform(sequence(0, size(iw) - 1), j -> shift + j >= 0 and shift + j < size(words) and coalesce(get(words, shift + j) = iw[j], false))")
    starts = let(same, lambda x: F.filter(F.sequence(F.lit(0), F.size(x) - F.col("width")), lambda s: F.forall(F.slice(x, s + 1, F.col("width")), lambda y: y)))
    hits = lined.select("doc_id", "text_hash", "item_id", "shift", "width", F.explode(starts).alias("s")).select("doc_id", "text_hash", "item_id", (F.col("shift") + F.col("s")).alias("a"), (F.col("shift") + F.col("s") + F.col("width")).alias("b"))
    if repetitive:
        hits = hits.unionByName(_window_hits(full, items.join(often, "item")))
    hits, hits_path = store(hits.distinct(), "hits")
    by_start = Window.partitionBy("doc_id", "text_hash").orderBy("a", "b")
    spans = hits.select("doc_id", "text_hash", "a", "b").distinct().withColumn("before", F.max("b").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    covered = spans.groupBy("doc_id", "text_hash").agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce("before", F.lit(0))))).cast("long").alias("n_hit"))
    named = hits.where("item_id is not null").groupBy("doc_id", "text_hash").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    told = covered.join(named.withColumnsRenamed(renamed), key, "left").select("doc_id", "text_hash", "n_hit", "ids")
    told, _ = store(told, "told")
    drop(docs.sparkSession, near_path, full_path, hits_path, place_path, items_path, often_path)
    told = sized(told.withColumnsRenamed(renamed), limit=200_000)
    out = table.select("doc_id", "text_hash", "n_words").join(told, key, "left")
    ids = F.sort_array(F.coalesce("ids", F.array().cast("array<string>")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_hash")


def _window_hits(full: DataFrame, items: DataFrame) -> DataFrame:
    """Occurrences (doc_id, text_hash, item_id, a, b) of the distinct windows of items in texts, by the words themselves."""
    windows = lambda words, width: F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.array_join(F.slice(words, i + 1, width), " "))
    own = items.withColumn("width", F.least(F.lit(WINDOW), F.size("iw")))
    own = own.select("item_id", "width", F.explode(F.array_distinct(windows(F.col("iw"), F.col("width")))).alias("w")).distinct()
    found = None
    # at most 13 widths
    for width in sorted(r[0] for r in own.select("width").distinct().collect()):
        spots = full.where(F.size("words") >= width).select("doc_id", "text_hash", F.posexplode(windows(F.col("words"), F.lit(width))).alias("a", "w"))
        part = spots.join(own.where(F.col("width") == width), "w").select("doc_id", "text_hash", "item_id", "a", (F.col("a") + width).alias("b"))
        found = part if found is None else found.unionByName(part)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the benchmark does not contaminate; rows without words stay. Rows of one
    id and text go or stay together; an empty table stays empty, an empty benchmark keeps all."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    return docs.join(sized(bad), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t")), "left_anti")
