"""Linked pairs among rows that share a key, found bucket by bucket in sorted order.

A bucket is never expanded into rows: tasks read rows sorted by key, compare neighbours inside numpy and give back a
spanning forest of the true links.  A bucket with more than ``BLOCK`` rows is cut into blocks and every two blocks meet
in a bucket of their own, so no task holds more than two blocks of a key, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.common import small_or_plain, stored

#: Rows of a bucket that meet at once.
BLOCK = 2_048
#: Pairs compared in one step.
STEP = 500_000


def crowded(keyed: DataFrame, key: str = "key") -> DataFrame:
    """Rows that share their key with another row, with the bucket they meet in (``key``, ``pair``).

    ``own`` is the row's block, ``blocks`` the number of blocks of its key.

    ``keyed`` needs ``key`` and a distinct long ``node``; it must be a stored table, since it's read twice.
    """
    size = keyed.groupBy(key).agg(F.count("*").alias("_size")).where("_size > 1")
    size = stored(size, "buckets")
    n = size.count()
    rows = keyed.join(small_or_plain(size, n), key)
    rows = rows.withColumn("blocks", F.ceil(F.col("_size") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    # Block i meets every other block j once: pair number low * blocks + high.
    partners = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_except(F.sequence(F.lit(0), F.col("blocks") - 1), F.array("own")))
    rows = rows.withColumn("_with", F.explode(partners))
    pair = F.when(F.col("blocks") == 1, F.lit(0)).otherwise(F.least("own", "_with") * F.col("blocks") + F.greatest("own", "_with"))
    return rows.withColumn("pair", pair).drop("_with", "_size")


def sorted_buckets(rows: DataFrame, key: str = "key") -> DataFrame:
    return rows.repartition(F.col(key), F.col("pair")).sortWithinPartitions(key, "pair")


def whole_buckets(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that end where a bucket ends, with the bucket number of each row."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        number = _numbers(held, key)
        cut = int(np.searchsorted(number, number[-1])) if len(number) else 0
        if cut:
            yield held.slice(0, cut).combine_chunks(), number[:cut]
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held.combine_chunks(), _numbers(held, key)


def _numbers(t: pa.Table, key: str) -> np.ndarray:
    k, p = t.column(key).to_numpy(), t.column("pair").to_numpy()
    new = np.ones(len(k), dtype=np.int64)
    if len(k):
        new[1:] = (k[1:] != k[:-1]) | (p[1:] != p[:-1])
    return np.cumsum(new)


def pairs(number: np.ndarray, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of rows with the same (sorted) bucket number, in bounded steps."""
    start = np.arange(len(number))
    room = np.searchsorted(number, number, side="right") - start - 1
    done = 0
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    while True:
        done += 1
        start, room = start[room >= done], room[room >= done]
        if not len(start):
            break
        held.append((start, start + done))
        size += len(start)
        if size >= step:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def links_of(rows: DataFrame, test: Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], np.ndarray]]) -> DataFrame:
    """Spanning forest ``u, v`` of the links among rows of :func:`crowded`.

    ``test(table)`` gives a function from index pairs to a mask of those that are links.
    """
    from panelcast.llm.components import forest

    def run(batches):
        for t, number in whole_buckets(batches):
            linked = test(t)
            node = t.column("node").to_numpy()
            u, v = np.empty(0, np.int64), np.empty(0, np.int64)
            for i, j in pairs(number):
                good = linked(i, j)
                u, v = forest(np.concatenate([u, node[i[good]]]), np.concatenate([v, node[j[good]]]))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return sorted_buckets(rows).mapInArrow(run, "u long, v long")
