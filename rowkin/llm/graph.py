"""Connected components: rounds of joins on tables in the shared folder, then one task for a small rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.llm.common import materialise, release

#: Edges (16 bytes each) that one task may finish; more go through rounds of joins first.
ONE_TASK = 1_000_000


def union(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots): the least node of each one's component, by lowering labels along edges and halving paths."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (before == label).all():
            return nodes, nodes[label]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        nodes, roots = union(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["node", "root"])


def _reading(df: DataFrame, table: DataFrame) -> DataFrame:
    df.rowkin_reads = (table,)
    return df


def components(edges: DataFrame, a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """(node, root): root is the smallest node of its component; only nodes with an edge.

    Alternates large-star and small-star steps: each replaces the edges by at most
    as many, and the depth of what is left falls by a constant factor, so a group
    of any size needs few rounds. ``release`` of the result drops the table it reads. A node's least neighbour is found with partial
    aggregation. Once the edges fit one task's bound, that task finishes them.
    """
    pair = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    now = materialise(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if now.count() <= one_task:
        return _reading(now.coalesce(1).mapInArrow(_finish, "node long, root long"), now)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: the larger neighbours of a node point to its least neighbour
        large = now.select(F.col("v").alias("c"), F.col("u").alias("w")).join(least.withColumnRenamed("u", "c"), "c").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u != v").distinct())
        release(now)
        # small star: a node and its smaller neighbours point to the least of them
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(lower.select("u", F.col("m").alias("v"))).distinct()
        now = materialise(small)
        release(large)
        if now.count() <= one_task:
            return _reading(now.coalesce(1).mapInArrow(_finish, "node long, root long"), now)
        deep = now.select("u").join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        split = now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        if deep.union(split).isEmpty():
            return _reading(now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), now)
