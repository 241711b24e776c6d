"""Embedding near-dedup through a pivot-permutation index.

Pivots are reference vectors.  A vector is described by its ``NEAREST`` pivots, in the order of nearness.  Inverted
lists hold the vectors of each combination of ``SHARED`` of these, so two vectors meet if they share that many pivots.
What meets is verified by its cosine in double precision.  Every vector is indexed; only the pivots come from a bounded
sample.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.buckets import crowded, pairs, sorted_buckets, whole_buckets
from panelcast.llm.common import small_or_plain, stored
from panelcast.llm.components import components, forest

COSINE = 0.9
#: Vectors that pivots are chosen from (those with the smallest hash of their content), and pivots at most.
SAMPLE, PIVOTS = 8_192, 384
#: Pivots that describe a vector, and how many of them two vectors must share to meet.
NEAREST, SHARED = 6, 2
#: Pivots are less alike than this, so that they describe different regions.
PIVOT_COSINE = 0.7
#: Buckets from this size on are verified as one matrix product.
DENSE = 24
PAIRS_STEP = 50_000


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one, scaled by their largest component first (so nothing overflows)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: str):
    """Not NULL, not empty, no NULL or non-finite component, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.coalesce(F.forall(v, finite), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def choose_pivots(vectors: DataFrame, sample: int = SAMPLE, most: int = PIVOTS, alike: float = PIVOT_COSINE) -> dict[int, np.ndarray]:
    """Pivots (unit rows) by dimension, taken in hash order from a bounded sample, none too like an earlier one."""
    rows = vectors.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(sample).collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for size, vs in by_size.items():
        x = unit_rows(np.array(vs, dtype=np.float64))
        chosen = x[:0]
        for row in x:
            if len(chosen) < most and (not len(chosen) or (chosen @ row).max() < alike):
                chosen = np.vstack([chosen, row])
        out[size] = chosen
    return out


def _described(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each unit row, nearest first (of equally near ones the first)."""
    return np.argsort(-np.round(x @ pivots.T, 12), axis=1, kind="stable")[:, :nearest]


def _lists(described: np.ndarray, shared: int, pivots: int, size: int) -> np.ndarray:
    """One key for each combination of ``shared`` pivots out of a description; keys of other dimensions differ."""
    ordered = np.sort(described, axis=1)
    base = pivots + 1
    keys = []
    for chosen in combinations(range(ordered.shape[1]), min(shared, ordered.shape[1])):
        key = np.full(len(ordered), size, dtype=np.int64)
        for c in chosen:
            key = key * base + ordered[:, c] + 1
        keys.append(key)
    return np.stack(keys, axis=1)


def indexed(vectors: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST, shared: int = SHARED, most: int = PIVOTS) -> DataFrame:
    """The inverted lists: ``key, node, copies, x, wide, lists``, a row per vector and combination.

    x is the vector and ``lists`` all keys of the vector in order, both as bytes.  A vector whose components are 32-bit
    numbers travels as such; ``wide`` says that it isn't.

    Vectors of a dimension that the sample lacks have no pivots; they meet in one list per dimension.
    """
    known = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for b in batches:
            node, copies, v = b.column("node"), b.column("copies"), b.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            values = v.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                at = np.nonzero(sizes == size)[0]
                x = unit_rows(values[starts[at][:, None] + np.arange(size)])
                p = known.value.get(size)
                lists = _lists(_described(x, p, nearest), shared, most, size) if p is not None else np.full((len(x), 1), size, np.int64)
                node_, copies_ = node.take(pa.array(at)), copies.take(pa.array(at))
                raw = values[starts[at][:, None] + np.arange(size)]
                with np.errstate(over="ignore"):
                    narrow = raw.astype(np.float32)
                wide = (narrow != raw).any(axis=1)
                x_ = pa.array([(r if w else q).tobytes() for r, q, w in zip(raw, narrow, wide.tolist())], pa.binary())
                all_ = pa.array([r.tobytes() for r in np.sort(lists, axis=1)], pa.binary())
                for k in range(lists.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(lists[:, k])), node_, copies_, x_, pa.array(wide), all_], names=["key", "node", "copies", "x", "wide", "lists"])

    return vectors.select("node", "copies", "v").mapInArrow(run, "key long, node long, copies long, x binary, wide boolean, lists binary")


def _verify(cosine: float):
    """In each bucket: spanning links, and for each vector how many others link to it.

    A pair that shares several combinations is counted in the first of them only.  In blocks of a crowded bucket, a
    pair of the same block is counted in the meeting of that block with the lowest other one only.
    """

    def run(batches):
        for t, number in whole_buckets(batches):
            node, copies, key = (t.column(c).to_numpy() for c in ("node", "copies", "key"))
            own, pair, blocks = (t.column(c).to_numpy() for c in ("own", "pair", "blocks"))
            kinds = (np.float32, np.float64)
            flat = [np.frombuffer(r, kinds[w]) for r, w in zip(t.column("x").to_pylist(), t.column("wide").to_pylist())]
            sizes = np.array([len(r) for r in flat])
            u, v, count = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(len(node), np.int64)
            for size in np.unique(sizes).tolist():  # a bucket's vectors have one dimension
                at = np.nonzero(sizes == size)[0]
                x = unit_rows(np.array([flat[k] for k in at.tolist()], dtype=np.float64))
                lists = np.stack([np.frombuffer(r, np.int64) for r in t.column("lists").take(pa.array(at)).to_pylist()])
                for i, j in _close_pairs(x, number[at], cosine):
                    first = _first_shared(lists, i, j)
                    i, j = at[i], at[j]
                    u.append(node[i])
                    v.append(node[j])
                    lowest = np.where(own[i] == 0, 1, 0)
                    meeting = np.minimum(own[i], lowest) * blocks[i] + np.maximum(own[i], lowest)
                    counted = (first == key[i]) & ((blocks[i] == 1) | (own[i] != own[j]) | (pair[i] == meeting))
                    i, j = i[counted], j[counted]
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
            a, b = forest(np.concatenate(u), np.concatenate(v))
            some = np.nonzero(count)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[a, node[some]]), pa.array(np.r_[b, node[some]]), pa.array(np.r_[np.zeros(len(a), np.int64), count[some]])], names=["u", "v", "n"])

    return run


def _close_pairs(x, number, cosine):
    """Index pairs of rows in the same bucket whose cosine is large enough."""
    first = np.nonzero(np.r_[True, number[1:] != number[:-1]])[0]
    sizes = np.diff(np.r_[first, len(number)])
    for at, size in zip(first[sizes >= DENSE].tolist(), sizes[sizes >= DENSE].tolist()):
        own = x[at : at + size]
        for lo in range(0, size, 512):
            i, j = np.nonzero(own[lo : lo + 512] @ own.T >= cosine)
            i = i + lo
            yield at + i[i < j], at + j[i < j]
    rows = np.nonzero(np.repeat(sizes < DENSE, sizes))[0]
    for i, j in pairs(number[rows], PAIRS_STEP):
        i, j = rows[i], rows[j]
        good = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
        yield i[good], j[good]


def _first_shared(lists, i, j):
    """The smallest key that both vectors of each pair have."""
    out = np.empty(len(i), np.int64)
    for lo in range(0, len(i), PAIRS_STEP):
        a, b = lists[i[lo : lo + PAIRS_STEP]], lists[j[lo : lo + PAIRS_STEP]]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        out[lo : lo + PAIRS_STEP] = np.where(both, a, np.iinfo(np.int64).max).min(axis=1)
    return out


def near_vectors(table: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST, shared: int = SHARED, most: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """``id_col, n_links, component_id, kept`` per input row.

    n_links counts other rows linked directly, copies included; component_id is the smallest id reachable.  Vectors
    that are NULL, empty, zero or hold NULL or non-finite components link with nothing, nor do vectors of different
    dimensions.  A row without id has component_id NULL unless linked to one with an id, and kept is then false.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).withColumn("ok", usable("v"))
    # Equal vectors are one node: a group of copies is summed up before anything meets.  Adding 0.0 makes -0.0 equal to 0.0.
    content = F.when(F.col("ok"), F.transform("v", lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("v", content).withColumn("node", F.xxhash64("v"))
    same = rows.where("ok").groupBy("node", "v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    vectors = stored(same, "vectors")
    pivots = choose_pivots(vectors, sample, most)
    keyed = stored(indexed(vectors, pivots, nearest, shared, most), "pivot-lists")
    met = sorted_buckets(crowded(keyed)).mapInArrow(_verify(cosine), "u long, v long, n long")
    met = stored(met, "vector-links")
    roots = components(met.where("u <> v").select("u", "v"))
    links = met.where("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    named = vectors.select("node", "least", "copies").join(roots, "node", "left").join(links, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    classes = stored(classes, "vector-classes")
    slim = rows.select("id", "ok", F.when(F.col("ok"), F.col("node")).alias("node"))
    out = slim.join(small_or_plain(classes, classes.count()), "node", "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("ok"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
