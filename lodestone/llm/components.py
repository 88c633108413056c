"""Connected components over a table of links, without collecting links or labels anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import drop, store

#: Up to this many links (16 bytes each) one task finds their components.
ONE_TASK = 1_000_000


def _one(batches):
    batches = list(batches)
    a, b = (np.concatenate([x.column(c).to_numpy() for x in batches]) if batches else np.zeros(0, np.int64) for c in ("a", "b"))
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        # the roots of both ends take the lower label, then every node its root's
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[label], pa.int64())], ["node", "label"])


def labelled(links: DataFrame, limit: int = ONE_TASK) -> DataFrame:
    """``components``, in one task if a count shows that the links are at most ``limit``."""
    return links.coalesce(1).mapInArrow(_one, "node long, label long") if links.count() <= limit else components(links)


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``links``: (a, b), each link once in any direction. Returns (node, label) of the linked nodes.

    Alternates two exact steps until nothing changes: every node sends the smallest node it
    sees to its larger neighbours, then to its smaller ones (large star, small star), so that
    each component ends as a star around its smallest node. A hub's links never meet in one
    task: each step is a grouped minimum, combined before the shuffle, and a join.
    With ``rounds`` it stops early; equal labels then still mean connected. No links: no rows.
    """
    spark = links.sparkSession
    edges, path = store(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    done = 0
    while rounds is None or done < rounds:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: for each node u, link its larger neighbours to the smallest of u and its neighbours
        star = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        # small star: link u and its smaller neighbours to the smallest of them
        star = star.where("u <> v").distinct()
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        new = star.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        new, new_path = store(new, "edges")
        done += 1
        sums = [x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0] for x in (edges, new)]
        drop(spark, path)
        edges, path = new, new_path
        if sums[0] == sums[1]:
            break
    low = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    roots = edges.select(F.col("v").alias("node")).distinct().join(edges.select(F.col("u").alias("node")).distinct(), "node", "left_anti")
    return low.unionByName(roots.select("node", F.col("node").alias("label")))
