"""Quality by histogram gradient-boosted trees over statistics of the whole document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbdt
from .bytes_np import LOWER, NOT_SPACE, mix, slices, word_bounds, word_hashes
from .labelled import fitted, held_out
from .work import pick

#: Documents of each class that training sees at most.
EACH = 2500
FEATURES = ("log_bytes", "log_words", "word_length", "word_spread", "upper", "digit", "not_ascii", "stops", "commas", "marks", "symbols", "lines", "line_words", "distinct_words", "top_word", "same_as_last", "distinct_pairs", "distinct_lines", "one_letter", "long_words")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*chars]] = True
    return out


_CLASSES = [_table(x) for x in (bytes(range(65, 91)), b"0123456789", bytes(range(128, 256)), b".", b",;:", b"!?", b"#$%&*@^~|<>=+{}[]\\_/", b"\n")]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, features) of a block of texts."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.diff(offsets)
    per = np.maximum(size, 1)
    sums = [np.diff(np.concatenate(([0], np.cumsum(c[data])))[offsets]) for c in _CLASSES]
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offsets, NOT_SPACE)
    words, lengths, hashes = np.diff(first), ends - starts, word_hashes(low, starts, ends)
    per_word = np.maximum(words, 1)
    total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[first])
    mean = total(lengths) / per_word
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(size), np.log1p(words), mean
    out[:, 3] = np.sqrt(np.maximum(total(lengths.astype(float) ** 2) / per_word - mean**2, 0))
    for j, s in zip((4, 5, 6), sums[:3], strict=True):
        out[:, j] = s / per
    for j, s in zip((7, 8, 9, 10), sums[3:7], strict=True):
        out[:, j] = s / per_word
    lines = sums[7] + 1
    out[:, 11], out[:, 12] = np.log1p(lines), np.log1p(words / lines)
    repeat = np.concatenate(([False], hashes[1:] == hashes[:-1])) if len(hashes) else np.zeros(0, bool)
    repeat[first[:-1][words > 0]] = False
    out[:, 15] = total(repeat) / per_word
    out[:, 18], out[:, 19] = total(lengths <= 1) / per_word, total(lengths > 20) / per_word
    pairs = mix(hashes[:-1] + hashes[1:] * np.uint64(31)) if len(hashes) > 1 else np.zeros(0, np.uint64)
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate((offsets[:-1], breaks + 1, offsets[-1:])))
    sums_of = np.concatenate(([0], np.cumsum(hashes)))[np.searchsorted(starts, edges)] if len(hashes) else np.zeros(len(edges), np.uint64)
    line_hash, line_at = np.diff(sums_of.astype(np.uint64)), np.searchsorted(edges, offsets)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b > a:
            _, counts = np.unique(hashes[a:b], return_counts=True)
            out[i, 13], out[i, 14] = len(counts) / np.sqrt(b - a), counts.max() / (b - a)
            if b - a > 1:
                out[i, 16] = len(np.unique(pairs[a : b - 1])) / (b - a - 1)
            own = line_hash[line_at[i] : line_at[i + 1]]
            out[i, 17] = len(np.unique(own)) / max(len(own), 1)
    return out


def train(rows: list[tuple[str, int]]) -> gbdt.Trees:
    x = [statistics(data, offsets) for _, _, data, offsets in slices(pa.array([t for t, _ in rows], pa.large_string()))]
    return gbdt.fit(np.concatenate(x) if x else np.zeros((0, len(FEATURES))), np.array([y for _, y in rows], float))


def quality(docs: DataFrame, labels: DataFrame, each: int = EACH, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from at most ``each`` documents a class of ``labels`` (doc_id, quality) that are not
    held out; only the text enters a score. Null and empty texts are scored as texts of no
    bytes. With labels of one class the score is about that class; without labels it is 0.5.
    Repeated rows score equally; further columns are ignored.
    """
    trees = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, "quality", each, train))

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text"), 1 << 18):
                score = trees.value.score(statistics(data, offsets))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    texts = docs.select(*pick(docs, "doc_id", "text")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
