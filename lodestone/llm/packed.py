"""Packed exchanges: arrays dealt to buckets as binary columns, so that one row carries many values.

A task gathers what it deals until ``FLUSH`` bytes are together, so rows are few and large. A step
gets its rows bucket by bucket, a bucket a partition, and large buckets in pieces of whole keys:
besides the bucket's own bytes, a task's memory follows a piece (or the largest group of equal keys).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "bucket int, kind int, cols array<binary>"
#: Bytes that a task gathers before it sends rows, values of a piece, and values of a stored row (whole groups of equal keys stay together, however large).
FLUSH, PIECE, CHUNK = 6 << 20, 1 << 18, 1 << 16


def rows(buckets, kinds, cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(kinds, pa.int32()), pa.array(cols, pa.list_(pa.binary()))], ["bucket", "kind", "cols"])


def _hash(i: int) -> int:
    """Spark's hash of an int column (Murmur3, seed 42), by which ``repartition`` places rows."""
    mask, turn = 0xFFFFFFFF, lambda x, n: (x << n | x >> (32 - n)) & 0xFFFFFFFF
    h = 42 ^ (turn(i * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask)
    h = (turn(h, 13) * 5 + 0xE6546B64 & mask) ^ 4
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


@cache
def names(buckets: int) -> np.ndarray:
    """A number for each bucket that ``repartition`` sends to a partition of its own."""
    found: dict[int, int] = {}
    i = 0
    while len(found) < buckets:
        found.setdefault(_hash(i) % buckets, i)
        i += 1
    return np.array([found[p] for p in range(buckets)], np.int32)


class Dealer:
    """Deals values to buckets by a key."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size = buckets, {}, 0

    def add(self, key: np.ndarray, kind: int, cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        if len(key):
            bucket = (key.view(np.uint64) % np.uint64(self.buckets)).astype(np.uint16 if self.buckets < 1 << 16 else np.int32)
            self.held.setdefault(kind, []).append((bucket, *cols))
            self.size += sum(c.nbytes for c in cols)
            if self.size >= FLUSH:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        for kind in list(self.held):
            bucket, *cols = (np.concatenate(c) for c in zip(*self.held.pop(kind), strict=True))
            order = np.argsort(bucket, kind="stable")
            bucket, cols = bucket[order], [c[order] for c in cols]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            yield rows(names(self.buckets)[bucket[cuts[:-1]]], [kind] * (len(cuts) - 1), [[c[a:b].tobytes() for c in cols] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        self.size = 0


def dealt(buckets: int, values: Iterator[tuple[np.ndarray, int, tuple[np.ndarray, ...]]]) -> Iterator[pa.RecordBatch]:
    """Rows of all (key, kind, columns)."""
    dealer = Dealer(buckets)
    for key, kind, cols in values:
        yield from dealer.add(key, kind, cols)
    yield from dealer.flush()


def whole_groups(bucket: int, kind: int, first: np.ndarray, cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """Sorted values in rows of about CHUNK values; ``first`` marks where groups begin, and none is cut."""
    n, a = len(cols[0]), 0
    starts = np.append(np.flatnonzero(first), n)
    while a < n:
        b = int(starts[min(np.searchsorted(starts, a + CHUNK), len(starts) - 1)])
        yield rows([bucket], [kind], [[c[a:b].tobytes() for c in cols]])
        a = b


def received(batches, layout: dict[int, tuple], key: dict[int, int] | None = None) -> Iterator[tuple[int, dict[int, list[np.ndarray]]]]:
    """Bucket by bucket, in pieces of whole keys, the arrays of each kind, as ``layout`` types them; a kind that is not
    there has empty arrays. ``key`` names the key's column where it is not the first."""

    def made(held):
        found = {k: [np.concatenate([np.frombuffer(row[i], t) for row in held[k]]) for i, t in enumerate(layout[k])] for k in list(held)}
        pieces = 1 + max(len(c[0]) for c in found.values()) // PIECE
        of = {k: (c[(key or {}).get(k, 0)].view(np.uint64) >> np.uint64(33)) % np.uint64(pieces) for k, c in found.items()} if pieces > 1 else {}
        for i in range(pieces):
            yield {k: [np.zeros(0, t) for t in types] if k not in found else [c[of[k] == i] for c in found[k]] if pieces > 1 else found[k] for k, types in layout.items()}

    now, held = None, {}
    for batch in batches:
        for bucket, kind, cols in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if bucket != now and now is not None:
                for piece in made(held):
                    yield now, piece
                held = {}
            now = bucket
            held.setdefault(kind, []).append(cols.as_py())
    if now is not None:
        for piece in made(held):
            yield now, piece


def exchange(df: DataFrame, parts: int, step: Callable, schema: str = SCHEMA) -> DataFrame:
    """Rows of each bucket brought together, then ``step`` (which reads them by ``received``)."""
    return df.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(step, schema)


def edges(values: np.ndarray) -> np.ndarray:
    """True where a run of equal values begins."""
    return np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)


def run_ends(first: np.ndarray) -> np.ndarray:
    """For each value the end of its run, given where runs begin."""
    starts = np.flatnonzero(first)
    return np.repeat(np.append(starts[1:], len(first)), np.diff(np.append(starts, len(first))))
