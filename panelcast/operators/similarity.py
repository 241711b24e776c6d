"""Correlation, dynamic time warping and clustering of series.

Pairwise results are worked out block against block: a task holds two bounded
blocks of series, whatever the number of series or the length of time.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelcast.operators.stats import series_moments
from panelcast.plans.grid import Step, grid_index
from panelcast.plans.tiles import join_series
from panelcast.session import java_class, shared_dir

BLOCK_SERIES = 256
BLOCK_STEPS = 1024
# Series of a block in the search within a radius, and their points (8 MB) at most.
PAIR_SERIES, PAIR_POINTS = 4096, 1 << 20
# Points of each side that are aligned at a time: one diagonal of all pairs stays near the processor.
ALIGNED_POINTS = 1 << 17
# Cells of cost matrices held at a time: 32 MB.
MATRIX_CELLS = 1 << 22
# Tasks of a search within a radius, at most.
PAIR_TASKS = 4096
WARPING = Path(__file__).with_name("Warping.java")
#: Cells of a cost matrix up to which an alignment is traced in it; above, it is found by halves.
PATH_CELLS = 1 << 22


def _blocks_for(df: DataFrame, blocks: int | None) -> int:
    """Blocks of about ``BLOCK_SERIES`` series; counts them (a job) unless the number is given."""
    return blocks or max(1, -(-df.select("series_id").distinct().count() // BLOCK_SERIES))


def _written(df: DataFrame, purpose: str) -> DataFrame:
    """A table that several passes read, on the shared folder; nothing stays in executor memory."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _block_pairs(block: Column, blocks: int) -> Column:
    """All pairs (smaller, larger) of block numbers this block takes part in."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda other: F.struct(F.least(block, other).alias("a"), F.greatest(block, other).alias("b")),
    )


def correlation_matrix(
    df: DataFrame, step: Step, *, blocks: int | None = None, threshold: float | None = None, top: int | None = None
) -> DataFrame:
    """Pearson correlation of every two series over the steps both have.

    Series fall into ``blocks`` by hash, by default of about 256 series.
    Each block goes to every block pair it belongs to, cut into time tiles, and
    one small matrix product per tile gives the sums of all its pairs.  Only
    sums are shuffled again.  The result has one row per pair by definition;
    ``threshold`` keeps pairs of at least that absolute correlation, ``top``
    those among the ``top`` strongest of one of their two series (ties by name).
    """
    blocks = _blocks_for(df, blocks)
    centred = join_series(df, series_moments(df)).select(
        "series_id", grid_index(F.col("ts"), step).alias("_i"), (F.col("value") - F.col("_mean")).alias("_c")
    )
    block = F.pmod(F.hash("series_id"), F.lit(blocks))
    spread = (
        centred.where(F.col("_c").isNotNull())
        .withColumn("_block", block)
        .withColumn("_tile", F.floor(F.col("_i") / BLOCK_STEPS))
        .withColumn("_pair", F.explode(_block_pairs(F.col("_block"), blocks)))
        .select("series_id", "_i", "_c", "_block", "_tile", "_pair.a", "_pair.b")
    )
    columns = ["id_a", "id_b", "n", "sa", "sb", "saa", "sbb", "sab"]

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf["a"].iloc[0], pdf["b"].iloc[0]
        wide = pdf.pivot(index="_i", columns="series_id", values="_c")
        home = pdf.drop_duplicates("series_id").set_index("series_id")["_block"].reindex(wide.columns)
        x, known = wide.fillna(0.0).to_numpy(), wide.notna().to_numpy(dtype=float)
        left, right = (home == a).to_numpy(), (home == b).to_numpy()
        xa, xb, ka, kb = x[:, left], x[:, right], known[:, left], known[:, right]
        sums = [ka.T @ kb, xa.T @ kb, ka.T @ xb, (xa * xa).T @ kb, ka.T @ (xb * xb), xa.T @ xb]
        ids = wide.columns.to_numpy()
        ia, ib = np.meshgrid(ids[left], ids[right], indexing="ij")
        keep = (ia != ib) if a != b else (ia < ib)
        out = pd.DataFrame({"id_a": ia[keep], "id_b": ib[keep]})
        for name, s in zip(columns[2:], sums):
            out[name] = s[keep]
        swap = out["id_a"] > out["id_b"]
        flipped = out[swap].rename(
            columns={"id_a": "id_b", "id_b": "id_a", "sa": "sb", "sb": "sa", "saa": "sbb", "sbb": "saa"}
        )
        return pd.concat([out[~swap], flipped])[columns]

    schema = "id_a string, id_b string, n double, sa double, sb double, saa double, sbb double, sab double"
    parts = spread.groupBy("a", "b", "_tile").applyInPandas(products, schema)
    sums = parts.groupBy("id_a", "id_b").agg(*[F.sum(c).alias(c) for c in columns[2:]])
    n = F.col("n")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / n
    var_a = F.col("saa") - F.col("sa") * F.col("sa") / n
    var_b = F.col("sbb") - F.col("sb") * F.col("sb") / n
    pairs = sums.where(n > 0).select(
        "id_a", "id_b", n.cast("bigint").alias("n"), F.try_divide(cov, F.sqrt(var_a * var_b)).alias("corr")
    )
    if threshold is not None:
        pairs = pairs.where(F.abs("corr") >= threshold)
    if top is not None:
        each = pairs.withColumn("_own", F.explode(F.array("id_a", "id_b")))
        strongest = Window.partitionBy("_own").orderBy(F.desc_nulls_last(F.abs("corr")), "id_a", "id_b")
        ranked = each.withColumn("_r", F.row_number().over(strongest)).where(F.col("_r") <= top)
        pairs = ranked.drop("_own", "_r").distinct()
    return pairs


def as_points(df: DataFrame) -> DataFrame:
    """A regular panel as one array of values per series (bounded by its number of steps)."""
    rows = F.array_sort(F.collect_list(F.struct("ts", "value")))
    return df.groupBy("series_id").agg(F.transform(rows, lambda r: r["value"]).alias("points"))


def warp_cost(a: np.ndarray, b: np.ndarray, band: int | None = None) -> np.ndarray:
    """Cumulative squared cost matrices for pairs of series, filled along anti-diagonals.

    ``a`` and ``b`` are [pair, time].  Entry [:, i + 1, j + 1] is the least cost
    of aligning the first i + 1 and j + 1 points.
    """
    pairs, n = a.shape
    m = b.shape[1]
    cost = np.full((pairs, n + 1, m + 1), np.inf)
    cost[:, 0, 0] = 0.0
    for d in range(n + m - 1):
        i = np.arange(max(0, d - m + 1), min(n, d + 1))
        j = d - i
        if band is not None:
            near = np.abs(i - j) <= max(band, abs(n - m))
            i, j = i[near], j[near]
        best = np.minimum(np.minimum(cost[:, i, j + 1], cost[:, i + 1, j]), cost[:, i, j])
        cost[:, i + 1, j + 1] = (a[:, i] - b[:, j]) ** 2 + best
    return cost


def warp_distance(a: np.ndarray, b: np.ndarray, band: int | None = None) -> np.ndarray:
    """Distances for pairs of series ([pair, time]); keeps three anti-diagonals, not the matrix."""
    return np.sqrt(_least_cost(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T), band))


def _least_cost(x: np.ndarray, y: np.ndarray, band: int | None = None) -> np.ndarray:
    """Least squared cost for pairs of series ([time, pair]; one column of ``y`` may serve all), in the numbers' own precision.

    Time runs along the first axis, so every step works on whole slices, and in place.
    """
    n, pairs = x.shape
    m = len(y)
    y = y[::-1]
    reach = n + m if band is None else max(band, abs(n - m))
    before, last, new = (np.full((n + 2, pairs), np.inf, x.dtype) for _ in range(3))
    before[0] = 0.0
    gaps = np.empty((min(n, m), pairs), x.dtype)
    for d in range(n + m - 1):
        lo = max(0, d - m + 1, -((reach - d) // 2))
        hi = min(n, d + 1, (d + reach) // 2 + 1)
        # Row i + 1 holds the cost of ending at (i, d - i); y runs backwards.
        if band is not None:
            new[:] = np.inf
        new[lo], new[hi + 1] = np.inf, np.inf
        if lo < hi:
            gap, best = gaps[: hi - lo], new[lo + 1 : hi + 1]
            np.subtract(x[lo:hi], y[m - 1 - d + lo : m - 1 - d + hi], out=gap)
            np.multiply(gap, gap, out=gap)
            np.minimum(last[lo:hi], last[lo + 1 : hi + 1], out=best)
            np.minimum(best, before[lo:hi], out=best)
            np.add(best, gap, out=best)
        before, last, new = last, new, before
    return last[n]


def warp_path(a: np.ndarray, b: np.ndarray, band: int | None = None, cells: int = PATH_CELLS) -> list[tuple[int, int]]:
    """One best alignment, from the first points to the last.

    Without a band, a matrix of over ``cells`` is never filled: the path is found by halves.
    """
    if band is not None or len(a) * len(b) <= cells:
        return trace(warp_cost(a[None, :], b[None, :], band)[0])
    return _path_by_halves(a, b, cells)


def last_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared cost of aligning all of ``a`` with the first 1, 2, .. points of ``b``; holds three diagonals."""
    n, m = len(a), len(b)
    y, out = np.ascontiguousarray(b[::-1]), np.empty(m)
    before, last, new = (np.full(n + 2, np.inf) for _ in range(3))
    before[0] = 0.0
    for d in range(n + m - 1):
        lo, hi = max(0, d - m + 1), min(n, d + 1)
        gap = a[lo:hi] - y[m - 1 - d + lo : m - 1 - d + hi]
        best = np.minimum(last[lo:hi], last[lo + 1 : hi + 1])
        np.minimum(best, before[lo:hi], out=best)
        new[lo] = new[hi + 1] = np.inf
        new[lo + 1 : hi + 1] = gap * gap + best
        if hi == n:
            out[d - n + 1] = new[n]
        before, last, new = last, new, before
    return out


def _path_by_halves(a: np.ndarray, b: np.ndarray, cells: int) -> list[tuple[int, int]]:
    """Where a best path leaves the first half of ``a`` follows from the costs up to there and, backwards, from behind.

    Each half is then a problem of its own, so memory grows with the lengths and work is about twice that of one matrix.
    """
    path, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        x, y = a[i:i2], b[j:j2]
        if len(x) == 1:
            path += [(i, k) for k in range(j, j2)]
        elif len(x) * len(y) <= cells:
            path += [(i + p, j + q) for p, q in trace(warp_cost(x[None, :], y[None, :])[0])]
        else:
            half = len(x) // 2
            up, down = last_row(x[:half], y), last_row(x[half:][::-1], y[::-1])[::-1]
            straight, slant = up + down, up[:-1] + down[1:]
            # The next row begins in the same column, or in the one after.
            k = int(straight.argmin())
            after = k
            if len(slant) and slant.min() <= straight[k]:
                k = int(slant.argmin())
                after = k + 1
            todo += [(i + half, i2, j + after, j2), (i, i + half, j, j + k + 1)]
    return path


def trace(cost: np.ndarray) -> list[tuple[int, int]]:
    """Walk a filled cost matrix back from its end; the diagonal step wins ties."""
    i, j = cost.shape[0] - 1, cost.shape[1] - 1
    path = []
    while i > 0 and j > 0:
        path.append((i - 1, j - 1))
        moves = [(cost[i - 1, j - 1], i - 1, j - 1), (cost[i - 1, j], i - 1, j), (cost[i, j - 1], i, j - 1)]
        _, i, j = min(moves, key=lambda x: x[0])
    return path[::-1]


def warp_bound(a: np.ndarray, b: np.ndarray, band: int | None = None) -> np.ndarray:
    """A lower bound of the distance for pairs of series ([pair, time]).

    Every point of one series is aligned with some point of the other within the band, so it costs at least its
    distance to the range of those points; the larger of both directions.
    """

    def one(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        n, m = x.shape[1], y.shape[1]
        if band is None:
            low, high = y.min(axis=1, keepdims=True), y.max(axis=1, keepdims=True)
        else:
            reach = max(band, abs(n - m))
            lo = [np.clip(i - reach, 0, m - 1) for i in range(n)]
            hi = [np.clip(i + reach, 0, m - 1) + 1 for i in range(n)]
            low = np.stack([y[:, p:q].min(axis=1) for p, q in zip(lo, hi)], axis=1)
            high = np.stack([y[:, p:q].max(axis=1) for p, q in zip(lo, hi)], axis=1)
        return (np.maximum(np.maximum(x - high, low - x), 0.0) ** 2).sum(axis=1)

    return np.sqrt(np.maximum(one(a, b), one(b, a)))


def close_pairs(x: np.ndarray, y: np.ndarray, radius: float, band: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs ([time, pair]) at most ``radius`` apart.

    Pairs are first aligned in half the precision.  What that can be wrong by is added to the radius, and pairs within
    are aligned again in doubles, so none is lost or added.
    """
    near = np.arange(x.shape[1])
    if band is not None:
        near = near[warp_bound(x.T, y.T, band) <= radius * (1 + 1e-9)]
    else:
        steps, eps, largest = len(x) + len(y), float(np.finfo(np.float32).eps), max(np.abs(x).max(), np.abs(y).max())
        if largest < 1e15 and radius > 1e-15:
            p, q = x.astype(np.float32), y.astype(np.float32)
            limit = (radius + 2 * eps * largest * np.sqrt(steps)) ** 2 * (1 + 2 * eps * (steps + 4))

            def reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                """What the points outside the range of the other series cost; see :func:`warp_bound`."""
                out = np.maximum(np.subtract(a, b.max(axis=0)), np.subtract(b.min(axis=0), a))
                np.maximum(out, 0, out=out)
                return np.einsum("ij,ij->j", out, out)

            # The bound pays where it settles some pairs; the first ones tell.
            if (np.maximum(reach(p[:, :64], q[:, :64]), reach(q[:, :64], p[:, :64])) > limit).mean() > 0.1:
                near = near[np.maximum(reach(p, q), reach(q, p)) <= limit]
                p, q = np.take(p, near, axis=1), np.take(q, near, axis=1)
            near = near[_least_cost(p, q) <= limit]
    if not len(near):
        return near, np.empty(0)
    distance = np.sqrt(_least_cost(np.take(x, near, axis=1), np.take(y, near, axis=1), band))
    within = distance <= radius
    return near[within], distance[within]


def add_alignments(cost: np.ndarray, members: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
    """Add every member's points to the centre positions that its best alignment gives them.

    All pairs of filled matrices are walked back together, by the rule of :func:`trace`.
    """
    pair = np.arange(len(cost))
    i, j = np.full(len(cost), cost.shape[1] - 1), np.full(len(cost), cost.shape[2] - 1)
    while len(pair):
        np.add.at(total, i - 1, members[pair, j - 1])
        np.add.at(count, i - 1, 1)
        moves = np.stack([cost[pair, i - 1, j - 1], cost[pair, i - 1, j], cost[pair, i, j - 1]]).argmin(axis=0)
        i, j = i - (moves < 2), j - (moves != 1)
        live = (i > 0) & (j > 0)
        pair, i, j = pair[live], i[live], j[live]


def alignment_sums(centre: np.ndarray, members: np.ndarray, band: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the members' points ([time, member]) that best alignments give to each position of the centre.

    All pairs are aligned together, diagonal by diagonal, and walked back together, by the rule of :func:`trace`.
    """
    n, (m, pairs) = len(centre), members.shape
    y, x, reach = members[::-1], centre[:, None], n + m if band is None else max(band, abs(n - m))
    # [d, i] is the cost of ending at (i - 1, d - i - 1); what lies beside a diagonal is infinite.
    cost = np.empty((n + m + 1, n + 2, pairs))
    cost[0, 0], cost[0, 1], cost[1, :2] = 0.0, np.inf, np.inf
    for d in range(2, n + m + 1):
        lo, hi = max(1, d - m, -((reach - d) // 2)), min(n, d - 1, (d + reach) // 2) + 1
        cost[d, lo - 1], cost[d, hi] = np.inf, np.inf
        if lo < hi:
            best, last = cost[d, lo:hi], cost[d - 1]
            gap = x[lo - 1 : hi - 1] - y[m - d + lo : m - d + hi]
            np.multiply(gap, gap, out=gap)
            np.minimum(last[lo - 1 : hi - 1], last[lo:hi], out=best)
            np.minimum(best, cost[d - 2, lo - 1 : hi - 1], out=best)
            np.add(best, gap, out=best)
    flat, wide = cost.reshape(-1), (n + 2) * pairs
    pair, i, j = np.arange(pairs), np.full(pairs, n), np.full(pairs, m)
    places, values = [], []
    while len(pair):
        places.append(i - 1)
        values.append(members[j - 1, pair])
        at = (i + j - 1) * wide + i * pairs + pair
        up, left, slant = flat[at - pairs], flat[at], flat[at - wide - pairs]
        slants = (slant <= up) & (slant <= left)
        ups = ~slants & (up <= left)
        i, j = i - (slants | ups), j - ~ups
        live = (i > 0) & (j > 0)
        if not live.all():
            pair, i, j = pair[live], i[live], j[live]
    where, what = np.concatenate(places), np.concatenate(values)
    return np.bincount(where, what, minlength=n), np.bincount(where, minlength=n).astype(float)


def _add_alignments(centre: np.ndarray, members: np.ndarray, band: int | None, total: np.ndarray, count: np.ndarray) -> None:
    """:func:`alignment_sums` in portions; series too long for a matrix are walked one by one."""
    cells = (len(centre) + len(members) + 1) * (len(centre) + 2)
    if len(centre) * len(members) > PATH_CELLS:
        for member in members.T:
            where, what = np.array(warp_path(centre, member, band)).T
            total += np.bincount(where, member[what], minlength=len(centre))
            count += np.bincount(where, minlength=len(centre))
        return
    size = max(1, MATRIX_CELLS // cells)
    for start in range(0, members.shape[1], size):
        s, c = alignment_sums(centre, np.ascontiguousarray(members[:, start : start + size]), band)
        total += s
        count += c


def _by_length(lengths: np.ndarray, values: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> numbers of the series of that length, and their points ([time, series])."""
    starts, out = np.cumsum(lengths) - lengths, {}
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        out[length] = rows, values[starts[rows] + np.arange(length)[:, None]]
    return out


def _lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and points, one after the other, of a column of lists; a missing point is NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return lengths.astype(np.int64), column.flatten().to_numpy(zero_copy_only=False).astype(float)


def dtw_distance(a: Column, b: Column, band: int | None = None, cutoff: float | None = None) -> Column:
    """Warping distance of two array columns; rows of equal lengths are computed together.

    With ``cutoff``, pairs whose lower bound is beyond it get NULL without being aligned.
    """

    @F.pandas_udf("double")
    def distance(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        shapes: dict[tuple[int, int], list[int]] = {}
        x, y = x.to_numpy(), y.to_numpy()
        for r, (p, q) in enumerate(zip(x, y)):
            if p is not None and q is not None and len(p) and len(q):
                shapes.setdefault((len(p), len(q)), []).append(r)
        for rows in shapes.values():
            for start in range(0, len(rows), 1024):
                some = np.array(rows[start : start + 1024])
                p, q = np.stack(x[some]).astype(float), np.stack(y[some]).astype(float)
                near = np.ones(len(some), bool) if cutoff is None else warp_bound(p, q, band) <= cutoff
                if near.any():
                    out[some[near]] = warp_distance(p[near], q[near], band)
        return pd.Series(out)

    return distance(a, b)


def dtw_path(pairs: DataFrame, a: str = "points_a", b: str = "points_b") -> DataFrame:
    """Add ``path``, one best alignment of the two arrays of each row."""

    @F.pandas_udf("array<struct<i: int, j: int>>")
    def paths(x: pd.Series, y: pd.Series) -> pd.Series:
        both = [(np.asarray(p, dtype=float), np.asarray(q, dtype=float)) for p, q in zip(x, y)]
        return pd.Series([[{"i": i, "j": j} for i, j in warp_path(p, q)] for p, q in both])

    return pairs.withColumn("path", paths(a, b))


def dtw_matrix(df: DataFrame, *, blocks: int | None = None, band: int | None = None) -> DataFrame:
    """Distance of every two series (``series_id, points``), block against block.

    One row per pair by definition; for large sets use :func:`dtw_within`.
    """
    blocks = _blocks_for(df, blocks)
    block = F.pmod(F.hash("series_id"), F.lit(blocks))
    spread = (
        df.select("series_id", "points", block.alias("_block"))
        .withColumn("_pair", F.explode(_block_pairs(F.col("_block"), blocks)))
        .select("series_id", "points", "_block", "_pair.a", "_pair.b")
    )

    def distances(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf["a"].iloc[0], pdf["b"].iloc[0]
        left, right = pdf[pdf["_block"] == a], pdf[pdf["_block"] == b]
        out = []
        for sid, points in zip(left["series_id"], left["points"]):
            others = right[right["series_id"] > sid] if a == b else right
            for _, same in others.groupby(others["points"].map(len)):
                y = np.stack(same["points"].to_numpy())
                x = np.tile(np.asarray(points, dtype=float), (len(y), 1))
                ids = same["series_id"]
                out.append(
                    pd.DataFrame(
                        {
                            "id_a": np.minimum(ids.to_numpy(), sid),
                            "id_b": np.maximum(ids.to_numpy(), sid),
                            "distance": warp_distance(x, y, band),
                        }
                    )
                )
        return pd.concat(out) if out else pd.DataFrame(columns=["id_a", "id_b", "distance"])

    return spread.groupBy("a", "b").applyInPandas(distances, "id_a string, id_b string, distance double")


def dtw_within(
    df: DataFrame, radius: float, *, within: Sequence[str] = (), band: int | None = None
) -> DataFrame:
    """All pairs of series at most ``radius`` apart, of any lengths, for pairs that agree in ``within``.

    Any alignment pairs the two first and the two last points, so those may
    differ by at most ``radius`` each: only series in the same or neighbouring
    cells of a grid of that width over (first, last) meet.  Cells are cut into
    blocks of at most about ``PAIR_SERIES`` series; a task holds two blocks, and
    a series travels once per block that its own meets, not once per pair.
    Without a band, a task aligns them inside the JVM, one series with several
    side by side (``Warping.java``); with one, pairs are aligned if the bound of
    :func:`warp_bound` does not already put them beyond the radius.  Series that
    are empty, or hold a missing or infinite point, have no partner.
    Where all series are within a few radii the number of alignments is that of
    all pairs.  The series are written first (a job).
    """
    within = list(within)
    cell = [*within, "_cx", "_cy"]
    points = F.col("points").cast("array<double>")
    finite = F.forall(points, lambda p: F.abs(p) < float("inf"))
    placed = df.where((F.size("points") > 0) & finite).select(
        "series_id",
        points.alias("points"),
        *within,
        F.floor(F.element_at(points, 1) / radius).alias("_cx"),
        F.floor(F.element_at(points, -1) / radius).alias("_cy"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = _written(placed.where(" AND ".join(f"`{c}` IS NOT NULL" for c in ["series_id", *cell])), "warping")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / PAIR_SERIES, F.sum(F.size("points")) / PAIR_POINTS))
    cells = placed.groupBy(*cell).agg(blocks.cast("int").alias("_blocks"), F.count(F.lit(1)).alias("_series"))
    cells = _written(cells.withColumn("_cell", F.monotonically_increasing_id()), "cells")

    # Each two neighbours meet once: half of the cells around, and the cell itself.
    ahead = F.array(*[F.struct(F.lit(dx).alias("x"), F.lit(dy).alias("y")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    left = cells.withColumn("_s", F.explode(ahead)).select(
        *within,
        (F.col("_cx") + F.col("_s.x")).alias("_cx"),
        (F.col("_cy") + F.col("_s.y")).alias("_cy"),
        F.col("_cell").alias("a"),
        F.col("_blocks").alias("_a_blocks"),
        F.col("_series").alias("_a_series"),
    )
    met = left.join(cells.withColumnRenamed("_cell", "b"), cell)
    # Rows that travel: every block once per block it meets.
    travels = (F.col("_a_series") * F.col("_blocks") + F.col("_series") * F.col("_a_blocks")).cast("double")
    buckets = met.agg(F.ceil(F.sum(travels) / (2 * PAIR_SERIES)).cast("long")).first()[0] or 1
    pairs = met.select("a", "b", "_blocks", F.explode(F.sequence(F.lit(0), F.col("_a_blocks") - 1)).alias("i"))
    first = F.when(F.col("a") == F.col("b"), F.col("i")).otherwise(0)
    pairs = pairs.select("a", "b", "i", F.explode(F.sequence(first, F.col("_blocks") - 1)).alias("j"))
    one = F.struct(F.col("a").alias("_cell"), F.col("i").alias("_block"), F.lit(0).alias("side"))
    other = F.struct(F.col("b").alias("_cell"), F.col("j").alias("_block"), F.lit(1).alias("side"))
    alone = (F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))
    # Many small pairs of blocks share a call; a large one has it nearly to itself.
    bucket = F.pmod(F.xxhash64("a", "i", "b", "j"), F.lit(buckets)).alias("_bucket")
    members = pairs.select("a", "i", "b", "j", bucket, F.inline(F.when(alone, F.array(one)).otherwise(F.array(one, other))))
    block = F.pmod(F.xxhash64("_row"), F.col("_blocks")).cast("int")
    series = placed.join(cells, cell).select("series_id", "points", "_cell", block.alias("_block"))
    spread = series.join(members, ["_cell", "_block"]).select("_bucket", "a", "i", "b", "j", "side", "series_id", "points")
    kind = df.schema["series_id"].dataType
    schema = StructType([StructField("id_a", kind), StructField("id_b", kind), StructField("distance", DoubleType())])
    warping = java_class(df.sparkSession, WARPING, "panelcast.Warping") if band is None else None
    if warping is None:
        dealt = spread.repartition(min(buckets, PAIR_TASKS), "_bucket")
        found = dealt.groupBy("_bucket").applyInArrow(_meetings(radius, band), schema)
    else:
        # Pairs of blocks are read one after the other; many parts leave few large ones to a task.
        dealt = spread.drop("_bucket").repartition(min(8 * buckets, PAIR_TASKS), "a", "i", "b", "j")
        found = _meetings_in_jvm(dealt, warping, radius, schema)
    swap = F.col("id_a") > F.col("id_b")
    return found.where("id_a <> id_b").select(
        F.when(swap, F.col("id_b")).otherwise(F.col("id_a")).alias("id_a"),
        F.when(swap, F.col("id_a")).otherwise(F.col("id_b")).alias("id_b"),
        "distance",
    )


def _meetings_in_jvm(spread: DataFrame, warping, radius: float, schema: StructType) -> DataFrame:
    """As :func:`_meetings` without a band, over rows (a, i, b, j, side, series_id, points)."""
    spark = spread.sparkSession
    jvm, session = spark.sparkContext._jvm, spark._jsparkSession
    values = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 1)
    values[0] = float(radius)
    run = warping.getConstructors()[0].newInstance(values)
    rows = spread.sortWithinPartitions("a", "i", "b", "j", "side")
    encoder = jvm.org.apache.spark.sql.Encoders.row(session.parseDataType(schema.json()))
    return DataFrame(rows._jdf.mapPartitions(run, encoder), spark)


def _meetings(radius: float, band: int | None):
    """Pairs of blocks -> pairs of their series at most ``radius`` apart."""

    def run(part: pa.Table) -> pa.Table:
        lengths, values = _lists(part.column("points"))
        starts = np.cumsum(lengths) - lengths
        first, last = values[starts], values[starts + lengths - 1]
        place = np.empty(len(lengths), dtype=np.int64)
        points = {}
        for length, (rows, table) in _by_length(lengths, values).items():
            place[rows], points[length] = np.arange(len(rows)), table
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[tuple[int, int], int] = {}

        def align(shape: tuple[int, int]) -> None:
            a, b = (np.concatenate(c) for c in zip(*waiting.pop(shape)))
            del sizes[shape]
            size = max(1, ALIGNED_POINTS // max(shape))
            for start in range(0, len(a), size):
                p, q = a[start : start + size], b[start : start + size]
                x, y = np.take(points[shape[0]], place[p], axis=1), np.take(points[shape[1]], place[q], axis=1)
                near, distance = close_pairs(x, y, radius, band)
                found.append((p[near], q[near], distance))

        def meet(a: np.ndarray, b: np.ndarray, same: bool) -> None:
            for n in np.unique(lengths[a]).tolist():
                for m in np.unique(lengths[b]).tolist():
                    if same and n > m:
                        continue
                    p, q = a[lengths[a] == n], b[lengths[b] == m]
                    for start in range(0, len(p), 256):
                        some = p[start : start + 256, None]
                        ends = (first[some] - first[q]) ** 2 + (last[some] - last[q]) ** 2 <= radius * radius
                        if same and n == m:
                            ends &= some < q
                        i, j = np.nonzero(ends)
                        if len(i):
                            waiting.setdefault((n, m), []).append((some[i, 0], q[j]))
                            sizes[n, m] = sizes.get((n, m), 0) + len(i)
                            if sizes[n, m] >= 4 * ALIGNED_POINTS // max(n, m):
                                align((n, m))

        keys = np.stack([part.column(c).to_numpy() for c in ("side", "j", "b", "i", "a")])
        order = np.lexsort(keys)
        keys = keys[:, order]
        begins = np.flatnonzero(np.r_[True, (keys[1:, 1:] != keys[1:, :-1]).any(axis=0)])
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(order)]):
            side, rows = keys[0, begin:end], np.sort(order[begin:end])
            _, j, b, i, a = keys[:, begin]
            if a == b and i == j:
                meet(rows, rows, True)
            else:
                cut = int(np.searchsorted(side, 1))
                meet(order[begin : begin + cut], order[begin + cut : end], False)
        for shape in list(waiting):
            align(shape)
        a, b, distance = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        ids = part.column("series_id")
        return pa.table({"id_a": ids.take(pa.array(a)), "id_b": ids.take(pa.array(b)), "distance": distance})

    return run


def dtw_cluster(
    df: DataFrame, k: int = 3, *, max_iter: int = 100, tol: float = 1e-4, band: int | None = None
) -> DataFrame:
    """k-means under warping; a centre is the average of its members along their best alignments.

    Runs one job per round.  A round sends out the k centres (k arrays), aligns
    every series with them inside the tasks, and brings back only sums per
    centre and position, added up before the shuffle.  Starts from the series
    with the lowest hashes and stops when a round lowers the sum of squared
    distances by no more than a share of ``tol``; ``converged`` says whether one
    did within ``max_iter`` rounds.
    """
    spark = df.sparkSession
    # Each round reads every file: two a core spread the work, many small ones would cost more than the work.
    df = _written(df.repartition(2 * spark.sparkContext.defaultParallelism, "series_id"), "warping")
    still, before = False, np.inf
    seeds = df.orderBy(F.xxhash64("series_id"), "series_id").limit(k).select("points").collect()
    centres = [np.asarray(r["points"], dtype=float) for r in seeds]

    def assign(series: dict[int, tuple[np.ndarray, np.ndarray]], rows: int, held) -> tuple[np.ndarray, np.ndarray]:
        table = np.full((rows, len(held)), np.inf)
        for length, (numbers, points) in series.items():
            size = max(1, ALIGNED_POINTS // (2 * max(1, length)))
            for start in range(0, len(numbers), size):
                x = np.ascontiguousarray(points[:, start : start + size])
                for c, centre in enumerate(held):
                    table[numbers[start : start + size], c] = np.sqrt(_least_cost(x, centre[:, None], band))
        return table.argmin(axis=1), table.min(axis=1)

    for _ in range(max_iter):
        shared = spark.sparkContext.broadcast(centres)

        def partial(batches):
            held, spread = shared.value, 0.0
            totals, counts = [np.zeros(len(c)) for c in held], [np.zeros(len(c)) for c in held]
            for batch in batches:
                lengths, values = _lists(batch.column(0))
                series = _by_length(lengths, values)
                owner, distance = assign(series, len(lengths), held)
                spread += float((distance**2).sum())
                for numbers, points in series.values():
                    for c, centre in enumerate(held):
                        mine = points[:, owner[numbers] == c]
                        if mine.shape[1]:
                            _add_alignments(centre, mine, band, totals[c], counts[c])
            rows = [(-1, 0, spread, 1.0)]
            rows += [(c, i, s, n) for c in range(len(held)) for i, (s, n) in enumerate(zip(totals[c].tolist(), counts[c].tolist()))]
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["c", "i", "s", "n"])

        sums = (
            df.select("points")
            .mapInArrow(partial, "c int, i int, s double, n double")
            .groupBy("c", "i")
            .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
            .where(F.col("n") > 0)
        )
        moved = [c.copy() for c in centres]
        spread = 0.0
        for r in sums.collect():  # k centres times their length, and the sum of squares
            if r["c"] < 0:
                spread = r["s"]
            else:
                moved[r["c"]][r["i"]] = r["s"] / r["n"]
        shared.unpersist()
        # The centres that were measured stay, not the ones they would move to.
        still = before - spread <= tol * before if np.isfinite(before) else spread == 0
        if still:
            break
        centres, before = moved, spread

    final = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("cluster int, distance double")
    def label(points: pd.Series) -> pd.DataFrame:
        lengths = points.map(len).to_numpy(dtype=np.int64)
        values = np.concatenate([np.asarray(p, dtype=float) for p in points]) if len(points) else np.empty(0)
        owner, distance = assign(_by_length(lengths, values), len(points), final.value)
        return pd.DataFrame({"cluster": owner.astype("int32"), "distance": distance})

    labelled = df.withColumn("_l", label("points"))
    return labelled.select("series_id", "_l.cluster", "_l.distance", F.lit(still).alias("converged"))


def _cluster_stages(features: Sequence[str], k: int, seed: int) -> list:
    return [
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
    ]


def cluster_series(fingerprints: DataFrame, features: Sequence[str], k: int = 3, *, seed: int = 42) -> DataFrame:
    """Standardise the features and run k-means (a job); one row per series with its cluster.

    The fingerprints, one row per series, are written for the passes of the fit.
    """
    fingerprints = _written(fingerprints, "fingerprints")
    model = Pipeline(stages=_cluster_stages(features, k, seed)).fit(fingerprints)
    return model.transform(fingerprints).select("series_id", F.col("cluster").cast("bigint").alias("cluster"))


def choose_k(fingerprints: DataFrame, features: Sequence[str], ks: Sequence[int] = (3, 4), *, seed: int = 42) -> DataFrame:
    """Silhouette per number of clusters; one fit per candidate."""
    score = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    fingerprints = _written(fingerprints, "fingerprints")
    rows = []
    for k in ks:
        model = Pipeline(stages=_cluster_stages(features, k, seed)).fit(fingerprints)
        rows.append((k, float(score.evaluate(model.transform(fingerprints)))))
    return fingerprints.sparkSession.createDataFrame(rows, "k int, silhouette double")
