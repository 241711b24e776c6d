"""Exponential smoothing: simple, linear trend, and seasonal (additive, multiplicative).

The recursions run along time, so a series is one unit of work; the panel is
regular, which bounds a unit by the number of grid steps however many raw rows
the series had.  Series spread over tasks.  Inside a task one pass carries all
parameter combinations at once as numpy vectors, and yields the forecasts of
every requested origin on the way: the cost of a rolling evaluation is one pass,
not one fit per origin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelcast.operators.forecast.baseline import key_schema, level_probs, shape_forecast
from panelcast.plans.grid import Step, grid_index, grid_time

Keys = Sequence[str]

# The parameter grids are part of each model's definition.
SES_GRID = [round(0.05 * i, 2) for i in range(1, 20)]
HOLT_GRID = [round(0.1 * i, 1) for i in range(1, 10)]
SEASONAL_GRID = [0.1, 0.3, 0.5, 0.7, 0.9]
REFINE = [-0.1, -0.05, 0.0, 0.05, 0.1]


def grid_for(kind: str) -> np.ndarray:
    """One row (alpha, beta, gamma) per combination, in ascending order."""
    if kind == "ses":
        return np.array([(a, 0.0, 0.0) for a in SES_GRID])
    if kind == "holt":
        return np.array([(a, b, 0.0) for a, b in product(HOLT_GRID, repeat=2)])
    return np.array(list(product(SEASONAL_GRID, repeat=3)))


def points_needed(kind: str, period: int) -> int:
    return {"ses": 2, "holt": 3}.get(kind, 2 * period)


@dataclass
class State:
    """Model state for all parameter rows after some number of points."""

    seen: int
    level: np.ndarray
    trend: np.ndarray
    season: np.ndarray | None
    sse: np.ndarray

    def ahead(self, row: int, steps: np.ndarray, kind: str) -> np.ndarray:
        line = self.level[row] + steps * self.trend[row]
        if self.season is None:
            return line
        s = self.season[row, (self.seen + steps - 1) % self.season.shape[1]]
        return line + s if kind == "add" else line * s


def run_model(y: np.ndarray, kind: str, period: int, grid: np.ndarray) -> Iterator[tuple[State, np.ndarray | None]]:
    """Yield (state, one-step errors of the newest point) from the first fit point to the last."""
    a, b, g = grid.T
    size = len(grid)
    season = None
    if kind == "ses":
        start, level, trend = 1, np.full(size, y[0]), np.zeros(size)
    elif kind == "holt":
        # The second point is predicted exactly by construction.
        start, level, trend = 1, np.full(size, y[0]), np.full(size, y[1] - y[0])
    else:
        start = period
        first, second = y[:period].mean(), y[period : 2 * period].mean()
        level, trend = np.full(size, first), np.full(size, (second - first) / period)
        shape = y[:period] - first if kind == "add" else y[:period] / first
        season = np.tile(shape, (size, 1))
    state = State(start, level, trend, season, np.zeros(size))
    yield state, None
    for t in range(start, len(y)):
        base = state.level + state.trend
        if season is None:
            error = y[t] - base
            level = a * y[t] + (1 - a) * base
        elif kind == "add":
            s = season[:, t % period]
            error = y[t] - base - s
            level = a * (y[t] - s) + (1 - a) * base
            season[:, t % period] = g * (y[t] - base) + (1 - g) * s
        else:
            s = season[:, t % period].copy()
            error = y[t] - base * s
            level = a * y[t] / s + (1 - a) * base
            season[:, t % period] = g * y[t] / base + (1 - g) * s
        if kind != "ses":
            state.trend = b * (level - state.level) + (1 - b) * state.trend
        state.level, state.sse, state.seen = level, state.sse + error * error, t + 1
        yield state, error


def best_rows(y: np.ndarray, kind: str, period: int, grid: np.ndarray, origins: Sequence[int], steps: np.ndarray):
    """Per origin: (winning row, its error sum, forecasts); the first row wins ties."""
    wanted = set(origins)
    out = {}
    for state, _ in run_model(y, kind, period, grid):
        if state.seen in wanted:
            row = int(np.nanargmin(state.sse)) if not np.all(np.isnan(state.sse)) else 0
            out[state.seen] = (row, float(state.sse[row]), state.ahead(row, steps, kind).copy())
    return out


def fit_origins(y: np.ndarray, kind: str, period: int, horizon: int, origins: Sequence[int]):
    """Per origin: (parameters, error sum, forecasts), after refining seasonal grids once."""
    steps = np.arange(1, horizon + 1)
    grid = grid_for(kind)
    coarse = best_rows(y, kind, period, grid, origins, steps)
    if kind in ("ses", "holt"):
        return {o: (grid[r], sse, f) for o, (r, sse, f) in coarse.items()}
    by_row: dict[int, list[int]] = {}
    for o, (r, _, _) in coarse.items():
        by_row.setdefault(r, []).append(o)
    out = {}
    for r, group in by_row.items():
        around = [np.clip(np.round(c + np.array(REFINE), 2), 0.0, 1.0) for c in grid[r]]
        fine = np.unique(np.array(list(product(*around))), axis=0)
        for o, (i, sse, f) in best_rows(y, kind, period, fine, group, steps).items():
            out[o] = (fine[i], sse, f)
    return out


def one_step_errors(y: np.ndarray, kind: str, period: int, params: np.ndarray) -> np.ndarray:
    return np.array([e[0] for _, e in run_model(y, kind, period, params[None, :]) if e is not None])


def usable(y: np.ndarray, kind: str, period: int) -> bool:
    if len(y) < points_needed(kind, period) or np.isnan(y).any():
        return False
    return kind != "mul" or bool((y > 0).all())


def fit_smoothing(
    df: DataFrame,
    kind: str,
    horizon: int,
    *,
    period: int = 12,
    keys: Keys = ("series_id",),
    level: float = 0.8,
) -> DataFrame:
    """One row per group: chosen parameters, error sum, forecasts and residual quantiles as arrays.

    Groups that are too short, hold NULLs, or are not positive for the
    multiplicative model give no row; ``evaluate.forecast_status`` names them
    and the reason.
    """
    probs = level_probs(level)
    names = list(keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        y = pdf["value"].to_numpy(dtype=float)
        columns = [*names, "origin_ts", "alpha", "beta", "gamma", "sse", "n", "yhat", "q"]
        if not usable(y, kind, period):
            return pd.DataFrame(columns=columns)
        params, sse, forecast = fit_origins(y, kind, period, horizon, [len(y)])[len(y)]
        q = np.quantile(one_step_errors(y, kind, period, params), probs)
        head = [pdf[k].iloc[0] for k in names]
        row = [*head, pdf["ts"].iloc[-1], *map(float, params), sse, len(y), forecast.tolist(), q.tolist()]
        return pd.DataFrame([row], columns=columns)

    schema = (
        f"{key_schema(df, keys)}, origin_ts timestamp_ntz, alpha double, beta double, gamma double, "
        "sse double, n bigint, yhat array<double>, q array<double>"
    )
    return df.select(*names, "ts", "value").groupBy(*names).applyInPandas(fit, schema)


def forecast_smoothing(
    df: DataFrame,
    kind: str,
    horizon: int,
    step: Step,
    *,
    period: int = 12,
    keys: Keys = ("series_id",),
    level: float = 0.8,
) -> DataFrame:
    fit = fit_smoothing(df, kind, horizon, period=period, keys=keys, level=level)
    pos = F.posexplode("yhat").alias("_p", "_y")
    rows = fit.select(*keys, "origin_ts", "q", pos).withColumn("h", (F.col("_p") + 1).cast("bigint"))
    rows = rows.withColumn("ts", grid_time(grid_index(F.col("origin_ts"), step) + F.col("h"), step))
    y = F.col("_y")
    return shape_forecast(rows, keys, y, y + F.col("q")[0], y + F.col("q")[1])


def forecast_ses(df: DataFrame, horizon: int, step: Step, **kw) -> DataFrame:
    """Simple smoothing: flat forecast at the last level; alpha from the grid with least error."""
    return forecast_smoothing(df, "ses", horizon, step, **kw)


def forecast_holt(df: DataFrame, horizon: int, step: Step, **kw) -> DataFrame:
    """Level and trend, extended on a line."""
    return forecast_smoothing(df, "holt", horizon, step, **kw)


def forecast_hw_add(df: DataFrame, horizon: int, step: Step, *, period: int = 12, **kw) -> DataFrame:
    """Trend and additive season; needs two full seasons."""
    return forecast_smoothing(df, "add", horizon, step, period=period, **kw)


def forecast_hw_mul(df: DataFrame, horizon: int, step: Step, *, period: int = 12, **kw) -> DataFrame:
    """Additive trend and multiplicative season; needs two full seasons of positive values."""
    return forecast_smoothing(df, "mul", horizon, step, period=period, **kw)


def rolling_smoothing(
    df: DataFrame, kind: str, *, train_size: int, max_horizon: int, period: int = 12, model: str | None = None
) -> DataFrame:
    """Evaluation rows of every origin from ``train_size`` on, parameters chosen per origin."""
    if train_size < points_needed(kind, period):
        raise ValueError(f"{kind} needs {points_needed(kind, period)} points to train on")
    name = model or kind
    columns = ["series_id", "model", "origin_ts", "horizon", "ts", "actual", "forecast", "error"]

    def evaluate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        y = pdf["value"].to_numpy(dtype=float)
        origins = range(train_size, len(y) - max_horizon + 1)
        if not len(origins) or not usable(y, kind, period):
            return pd.DataFrame(columns=columns)
        fits = fit_origins(y, kind, period, max_horizon, origins)
        at = np.repeat(np.fromiter(fits, dtype=int), max_horizon)
        h = np.tile(np.arange(1, max_horizon + 1), len(fits))
        forecast = np.concatenate([f for _, _, f in fits.values()])
        ts = pdf["ts"].to_numpy()
        actual = y[at + h - 1]
        return pd.DataFrame(
            {
                "series_id": pdf["series_id"].iloc[0],
                "model": name,
                "origin_ts": ts[at - 1],
                "horizon": h,
                "ts": ts[at + h - 1],
                "actual": actual,
                "forecast": forecast,
                "error": actual - forecast,
            }
        )

    schema = (
        "series_id string, model string, origin_ts timestamp_ntz, horizon bigint, ts timestamp_ntz, "
        "actual double, forecast double, error double"
    )
    return df.select("series_id", "ts", "value").groupBy("series_id").applyInPandas(evaluate, schema)


def smoothing_grid_scores(train: DataFrame, validation: DataFrame, kind: str, *, period: int = 12) -> DataFrame:
    """Per series and parameter row: RMSE of the forecasts from ``train`` on ``validation``."""
    both = train.select("series_id", "ts", "value", F.lit(True).alias("_train")).unionByName(
        validation.select("series_id", "ts", "value", F.lit(False).alias("_train"))
    )
    columns = ["series_id", "alpha", "beta", "gamma", "rmse"]

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        known = pdf["_train"].to_numpy()
        y, z = pdf["value"].to_numpy(dtype=float)[known], pdf["value"].to_numpy(dtype=float)[~known]
        if not len(z) or not usable(y, kind, period):
            return pd.DataFrame(columns=columns)
        grid = grid_for(kind)
        steps = np.arange(1, len(z) + 1)
        *_, (state, _) = run_model(y, kind, period, grid)
        rmse = [float(np.sqrt(np.mean((z - state.ahead(r, steps, kind)) ** 2))) for r in range(len(grid))]
        out = pd.DataFrame(grid, columns=["alpha", "beta", "gamma"])
        return out.assign(series_id=pdf["series_id"].iloc[0], rmse=rmse)[columns]

    schema = "series_id string, alpha double, beta double, gamma double, rmse double"
    return both.groupBy("series_id").applyInPandas(score, schema)
