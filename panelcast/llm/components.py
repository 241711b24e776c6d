"""Connected components of a graph given as links, without bringing links to the driver.

Each task first replaces its links by a spanning forest (stars below local minima), so at most one link per node
and task goes on.  Then rounds of contraction: every node is merged into its smallest neighbour (by number in even
rounds, by a hash that changes with the round in odd ones, which shrinks any graph by a constant factor on average),
until no link joins two different nodes.  Each round is a written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.common import stored

#: Links that a task reduces at a time.
FOREST_LINKS = 2_000_000


def local_labels(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 with links i-j: the smallest node of each node's component."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            break
        open_ = label[i] != label[j]
        if not open_.any() and np.array_equal(label, label[label]):
            break
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components: (smallest node, node) for each other node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = local_labels(at[: len(u)], at[len(u) :], len(nodes))
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def _forest_of_task(batches):
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        size += b.num_rows
        if size >= FOREST_LINKS:
            held = [forest(*(np.concatenate(x) for x in zip(*held)))]
            # What is left is a forest; a task passes it on if even that is large.
            size = len(held[0][0])
            if size >= FOREST_LINKS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["u", "v"])
                held, size = [], 0
    if held:
        u, v = forest(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """``u long, v long`` -> ``node long, root long``: one row per linked node.

    ``root`` is one node of the component, the same for all of its nodes (not necessarily the smallest).
    Links of a node with itself and links with NULL mean nothing; an empty frame gives no rows.
    """
    links = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    edges = stored(links.mapInArrow(_forest_of_task, "u long, v long"), "links")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        odd = len(steps) % 2
        rank = (lambda c, k=len(steps): F.xxhash64(F.col(c), F.lit(k))) if odd else (lambda c: F.col(c))
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min(F.struct(rank("v").alias("r"), F.col("v").alias("n"))).alias("best"))
        own = F.struct(rank("u").alias("r"), F.col("u").alias("n"))
        step = stored(best.select(F.col("u").alias("node"), F.least(own, F.col("best")).getField("n").alias("to")), "merge")
        steps.append(step)
        a = step.select(F.col("node").alias("u"), F.col("to").alias("a"))
        b = step.select(F.col("node").alias("v"), F.col("to").alias("b"))
        left = edges.join(a, "u").join(b, "v").where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = stored(left.repartition("u").mapInArrow(_forest_of_task, "u long, v long"), "links")
    if not steps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = steps[-1]
    for step in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("to"), F.col("to").alias("last"))
        found = step.join(later, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
    return found.select("node", F.col("to").alias("root"))
