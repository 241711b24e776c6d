"""Autoregressions fitted at many origins of a series from normal equations carried along it.

A fit needs only the product sums of its training rows, and those of a later origin are those of an earlier one plus
the rows between.  So a series is cut into tiles: each adds up its own sums, every tile gets the total of those before
it, and inside a tile the sums grow row by row (rank-one updates).  Each origin's regression is solved from its sums and
extended from the values before it; no training set is ever copied, and a long series is spread over its tiles.

The fits are those of ``forecast_sarima`` for orders without moving-average terms: (p, d, 0)(P, D, 0, s), the mean model
among them as (0, 0, 0).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelcast.operators.forecast.arima import FLAT, Order, Seasonal, Terms
from panelcast.plans.grid import Step, grid_index, grid_time

TILE_ROWS, CHUNK_ROWS = 65_536, 4_096
#: (position of each origin in its series, rows of the series) -> the number of the fold it starts, 0 for none.
Origins = Callable[[np.ndarray, int], np.ndarray]


def _dense(pdf: pd.DataFrame) -> tuple[int, np.ndarray]:
    """First grid index and the values from there on, NaN where there is none."""
    i = pdf["_i"].to_numpy()
    v = np.full(int(i.max() - i.min()) + 1, np.nan)
    v[i - i.min()] = pdf["value"].to_numpy(dtype=float)
    return int(i.min()), v


def _columns(v: np.ndarray, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """The differenced values, and per row constant, lagged differences and target; NaN where lags reach too far."""
    reach = len(terms.weights) - 1
    w = np.full(len(v), np.nan)
    if len(v) > reach:
        w[reach:] = np.convolve(v, terms.weights, mode="valid")
    lagged = [np.concatenate([np.full(min(k, len(w)), np.nan), w[: max(len(w) - k, 0)]]) for k in terms.ar]
    return w, np.column_stack([*([np.ones(len(w))] if terms.constant else []), *lagged, w])


def _solve(gram: np.ndarray) -> np.ndarray:
    """Coefficients of many regressions at once from their product sums (target last)."""
    k = gram.shape[1] - 1
    scale = np.sqrt(np.einsum("nii->ni", gram[:, :k, :k]))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(gram[:, :k, :k] / (scale[:, :, None] * scale[:, None, :]), hermitian=True, rcond=1e-12)
    return np.einsum("nij,nj->ni", inverse, gram[:, :k, k] / scale) / scale


def _extended(v: np.ndarray, w: np.ndarray, at: np.ndarray, beta: np.ndarray, terms: Terms, horizon: int) -> np.ndarray:
    """Forecasts 1 .. ``horizon`` steps after each place of ``at``."""
    c = int(terms.constant)
    take = lambda x, k: np.where(at - k >= 0, x[np.maximum(at - k, 0)], np.nan)
    values = {-k: take(v, k) for k in range(len(terms.weights))}
    changes = {-k: take(w, k) for k in range(max([0, *terms.ar]))}
    for h in range(1, horizon + 1):
        step = beta[:, 0].copy() if c else np.zeros(len(at))
        for j, k in enumerate(terms.ar):
            step += beta[:, c + j] * changes[h - k]
        changes[h] = step
        values[h] = step - sum(b * values[h - k] for k, b in enumerate(terms.weights) if k)
    return np.column_stack([values[h] for h in range(1, horizon + 1)])


def carried_forecasts(
    df: DataFrame, step: Step, origins: Origins, horizon: int, *, order: Order, seasonal: Seasonal = FLAT, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``series_id, fold, n_train, origin_ts, horizon, ts, actual, forecast`` for the chosen origins of a regular panel.

    ``forecast`` is NULL where the training rows hold a gap or are too few.  ``actual`` is NULL past the end.
    """
    terms = Terms.of(order, seasonal)
    if terms.ma:
        raise ValueError("moving-average terms can't be carried along: their regressors change with every origin")
    back = len(terms.weights) - 1 + max([0, *terms.ar])
    size = max(tile_rows, 2 * (back + horizon))
    m = int(terms.constant) + len(terms.ar) + 1
    rows = df.select("series_id", F.col("value").cast("double").alias("value"), grid_index(F.col("ts"), step).alias("_i"))
    spans = F.sequence(F.floor((F.col("_i") - horizon) / size), F.floor((F.col("_i") + back) / size))
    # One shuffle of the rows, which both passes below read; those near an edge are in the neighbour's tile as well.
    tiles = rows.withColumn("_tile", F.explode(spans)).repartition("series_id", "_tile")

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        tile = int(pdf["_tile"].iloc[0])
        first, v = _dense(pdf)
        i = np.arange(first, first + len(v))
        home = i // size == tile
        z = _columns(v, terms)[1][home]
        z = z[~np.isnan(z).any(axis=1)]
        present = pdf["_i"].to_numpy() // size == tile
        gaps = int(pdf["value"].isna().to_numpy()[present].sum())
        made = {"series_id": pdf["series_id"].iloc[0], "_tile": tile, "rows": int(present.sum()), "gaps": gaps, "n": len(z), "gram": [(z.T @ z).ravel()]}
        return pd.DataFrame(made, index=[0])

    def before(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_tile")
        gram = np.array(pdf["gram"].tolist()).reshape(len(pdf), m * m)
        out = {"series_id": pdf["series_id"], "_tile": pdf["_tile"], "total": int(pdf["rows"].sum()), "gram": list(np.cumsum(gram, axis=0) - gram)}
        return pd.DataFrame(out | {c: pdf[c].cumsum() - pdf[c] for c in ("rows", "gaps", "n")})

    def fits(pdf: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        names = ["series_id", "fold", "n_train", "_origin", "horizon", "actual", "forecast"]
        if not len(pdf) or not len(state):
            return pd.DataFrame(columns=names)
        s, tile = state.iloc[0], int(pdf["_tile"].iloc[0])
        first, v = _dense(pdf)
        w, z = _columns(v, terms)
        home = np.flatnonzero(np.arange(first, first + len(v)) // size == tile)
        if not len(home):
            return pd.DataFrame(columns=names)
        known = ~np.isnan(z).any(axis=1)
        z = np.where(known[:, None], z, 0.0)
        position = s["rows"] + 1 + np.arange(len(home))
        gaps = s["gaps"] + np.cumsum(np.isnan(v[home]))
        n = s["n"] + np.cumsum(known[home])
        fold = origins(position, int(s["total"]))
        gram, out = np.asarray(s["gram"]).reshape(m, m), []
        for a in range(0, len(home), CHUNK_ROWS):
            part = home[a : a + CHUNK_ROWS]
            grown = gram + np.cumsum(np.einsum("ni,nj->nij", z[part], z[part]), axis=0)
            gram = grown[-1]
            pick = np.flatnonzero(fold[a : a + CHUNK_ROWS] > 0)
            if not len(pick):
                continue
            at = part[pick]
            ahead = np.full((len(at), horizon), np.nan)
            good = (gaps[a + pick] == 0) & (n[a + pick] > m - 1)
            if good.any():
                ahead[good] = _extended(v, w, at[good], _solve(grown[pick[good]]), terms, horizon)
            place = at[:, None] + np.arange(1, horizon + 1)
            actual = np.where(place < len(v), v[np.minimum(place, len(v) - 1)], np.nan)
            each = lambda x: np.repeat(x, horizon)
            columns = [each(fold[a + pick]), each(position[a + pick]), each(first + at), np.tile(np.arange(1, horizon + 1), len(at)), actual.ravel(), ahead.ravel()]
            out.append(pd.DataFrame(dict(zip(names[1:], columns))))
        if not out:
            return pd.DataFrame(columns=names)
        return pd.concat(out).assign(series_id=pdf["series_id"].iloc[0])[names]

    keys = ["series_id", "_tile"]
    grams = tiles.groupBy(*keys).applyInPandas(sums, "series_id string, _tile bigint, rows bigint, gaps bigint, n bigint, gram array<double>")
    states = grams.groupBy("series_id").applyInPandas(before, "series_id string, _tile bigint, total bigint, gram array<double>, rows bigint, gaps bigint, n bigint")
    made = tiles.groupBy(*keys).cogroup(states.groupBy(*keys)).applyInPandas(
        fits, "series_id string, fold bigint, n_train bigint, _origin bigint, horizon bigint, actual double, forecast double"
    )
    value = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return made.select(
        "series_id",
        "fold",
        "n_train",
        grid_time(F.col("_origin"), step).alias("origin_ts"),
        "horizon",
        grid_time(F.col("_origin") + F.col("horizon"), step).alias("ts"),
        value("actual"),
        value("forecast"),
    )


def rolling_origins(train_size: int, horizon: int) -> Origins:
    """Every origin with so many rows before it and so many after it."""
    return lambda position, total: ((position >= train_size) & (position <= total - horizon)).astype(int)


def fold_origins(n_splits: int, test_size: int | None) -> Origins:
    """The last row before each of the ``n_splits`` test parts at the end; ``test_size`` None: n // (n_splits + 1) rows."""

    def of(position: np.ndarray, total: int) -> np.ndarray:
        size = total // (n_splits + 1) if test_size is None else test_size
        fold, rest = np.divmod(position - total + (n_splits + 1) * size, max(size, 1))
        return np.where((rest == 0) & (fold >= 1) & (fold <= n_splits) & (size > 0), fold, 0)

    return of
