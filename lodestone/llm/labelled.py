"""Labels that a classifier may learn from, and a model fitted to a bounded sample of them."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import pick


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5; those labels are never learned. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fitted(docs: DataFrame, labels: DataFrame, label: str, each: int, fit: Callable[[list[tuple[str, int]]], Any]) -> Any:
    """What ``fit`` makes, in one task, of (text, label) rows of at most ``each`` documents a class: the first by a hash
    of the id. Null texts and labels and held-out ids stay out; an id of several texts counts once a label, with the
    text of the smallest hash. Only the model reaches the driver."""
    labels = labels.select(*pick(labels, "doc_id", label)).where(f"`{label}` in (0, 1)").where(~held_out(F.col("doc_id")))
    chosen = None
    for value in (0, 1):
        part = labels.where(F.col(label) == value).select("doc_id", F.col(label).cast("int").alias("y")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        chosen = part if chosen is None else chosen.unionByName(part)
    docs = docs.select(*pick(docs, "doc_id", "text")).where("text is not null")
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches):
        held = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "y", "text")), strict=True)]
        model = fit([(t, y) for _, y, t in sorted(held, key=lambda r: r[:2])])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = rows.coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found[0]) if found else fit([])
