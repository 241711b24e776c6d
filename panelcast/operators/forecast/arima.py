"""ARIMA and seasonal ARIMA by regression (Hannan-Rissanen), one series per unit of work.

A regular series is bounded by its number of grid steps, so one shuffle brings
each series together and small least-squares problems run inside the tasks.
Moving-average terms take the residuals of a long autoregression as regressors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from panelcast.operators.forecast.baseline import key_schema, level_probs, shape_forecast
from panelcast.plans.grid import Step, grid_index, grid_time

Order = tuple[int, int, int]
Seasonal = tuple[int, int, int, int]
FLAT: Seasonal = (0, 0, 0, 0)


@dataclass(frozen=True)
class Terms:
    """Lags and differencing weights of one order."""

    ar: tuple[int, ...]
    ma: tuple[int, ...]
    weights: tuple[float, ...]
    constant: bool

    @classmethod
    def of(cls, order: Order, seasonal: Seasonal = FLAT) -> Terms:
        p, d, q = order
        sp, sd, sq, s = seasonal
        # The lags of the product of both polynomials; each has a coefficient of its own.
        ar = sorted({i + s * j for i in range(p + 1) for j in range(sp + 1)} - {0})
        ma = sorted({i + s * j for i in range(q + 1) for j in range(sq + 1)} - {0})
        weights = np.array([1.0])
        for _ in range(d):
            weights = np.convolve(weights, [1.0, -1.0])
        for _ in range(sd):
            weights = np.convolve(weights, [1.0, *[0.0] * (s - 1), -1.0])
        return cls(tuple(ar), tuple(ma), tuple(weights), d == 0 and sd == 0)

    @property
    def long_order(self) -> int:
        return max([*self.ar, *self.ma, 0]) + 5

    @property
    def points_needed(self) -> int:
        """The shortest series that both regressions have more rows than columns for."""
        reach, columns = len(self.weights) - 1, int(self.constant) + len(self.ar) + len(self.ma)
        least = max([reach, *self.ar, *self.ma]) + 1
        if self.ma:
            least = max(least, reach + 2 * self.long_order + 2, reach + self.long_order + self.ma[-1] + columns + 1)
        elif columns:
            least = max(least, reach + max([0, *self.ar]) + columns + 1)
        return least


@dataclass
class Fit:
    """Coefficients, differenced series, innovations used as regressors, and one-step residuals."""

    beta: np.ndarray
    w: np.ndarray
    shocks: np.ndarray
    resid: np.ndarray


def _lagged(x: np.ndarray, lags: Sequence[int]) -> np.ndarray:
    out = np.full((len(x), len(lags)), np.nan)
    for j, k in enumerate(lags):
        out[k:, j] = x[: max(len(x) - k, 0)]
    return out


def _regress(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Least squares on the complete rows; (coefficients, residuals with NaN elsewhere)."""
    rows = ~np.isnan(y) & ~np.isnan(x).any(axis=1)
    if rows.sum() <= x.shape[1]:
        return None
    scale = np.abs(x[rows]).max(axis=0, initial=0.0)
    scale[scale == 0] = 1.0
    beta = np.linalg.lstsq(x[rows] / scale, y[rows], rcond=None)[0] / scale
    return beta, y - x @ beta


def fit_terms(y: np.ndarray, terms: Terms) -> Fit | None:
    """Fit one series without gaps; None when it is too short for the regressions."""
    reach = len(terms.weights) - 1
    if len(y) <= max([reach, *terms.ar, *terms.ma]):
        return None
    w = np.concatenate([np.full(reach, np.nan), np.convolve(y, terms.weights, mode="valid")])
    one = np.ones((len(w), 1))
    shocks = np.zeros(len(w))
    x = np.hstack([one] * terms.constant + [_lagged(w, terms.ar)])
    if terms.ma:
        first = _regress(w, np.hstack([one, _lagged(w, range(1, terms.long_order + 1))]))
        if first is None:
            return None
        shocks = first[1]
        x = np.hstack([x, _lagged(shocks, terms.ma)])
    if not x.shape[1]:
        return Fit(np.zeros(0), w, shocks, w)
    got = _regress(w, x)
    if got is None:
        return None
    beta, resid = got
    if terms.ma:
        own = innovations(w, beta, terms)
        # A moving average that isn't invertible has innovations without bound; those of the first stage stand in.
        if np.isfinite(own[reach:]).all() and np.nanmax(np.abs(own)) <= 1e3 * np.nanmax(np.abs(w)):
            warm = reach + max([0, *terms.ar])
            shocks, resid = own, np.where(np.arange(len(w)) < warm, np.nan, own)
    return Fit(beta, w, np.nan_to_num(shocks), resid)


def innovations(w: np.ndarray, beta: np.ndarray, terms: Terms) -> np.ndarray:
    """One-step errors of the fitted model along the series; zero before its lags are known."""
    c = int(terms.constant)
    base = w - (beta[0] if c else 0.0) - _lagged(w, terms.ar) @ beta[c : c + len(terms.ar)]
    theta = beta[c + len(terms.ar) :]
    e = np.zeros(len(w) + terms.ma[-1])
    back = [terms.ma[-1] - k for k in terms.ma]
    with np.errstate(over="ignore", invalid="ignore"):
        for t, x in enumerate(base):
            if x == x:
                e[t + terms.ma[-1]] = x - sum(b * e[t + k] for b, k in zip(theta, back))
    return e[terms.ma[-1] :]


def extend_series(y: np.ndarray, fit: Fit, terms: Terms, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and the growth of their standard error."""
    c = int(terms.constant)
    constant = fit.beta[0] if c else 0.0
    phi = dict(zip(terms.ar, fit.beta[c:]))
    theta = dict(zip(terms.ma, fit.beta[c + len(terms.ar) :]))
    v, w, e = list(y), list(fit.w), list(fit.shocks)
    for _ in range(horizon):
        step = constant + sum(b * w[-k] for k, b in phi.items()) + sum(b * e[-k] for k, b in theta.items())
        w.append(step)
        e.append(0.0)
        v.append(step - sum(b * v[-k] for k, b in enumerate(terms.weights) if k))
    # Weights of past shocks in the forecast error: the model as one infinite moving average.
    ar_poly = np.zeros(max([0, *phi]) + 1)
    ar_poly[0] = 1.0
    for k, b in phi.items():
        ar_poly[k] = -b
    full = np.convolve(ar_poly, terms.weights)
    psi = np.zeros(horizon)
    for j in range(horizon):
        own = 1.0 if j == 0 else theta.get(j, 0.0)
        psi[j] = own - sum(full[i] * psi[j - i] for i in range(1, min(j, len(full) - 1) + 1))
    return np.array(v[-horizon:]), np.sqrt(np.cumsum(psi * psi))


def arima_residuals(df: DataFrame, order: Order, *, seasonal: Seasonal = FLAT) -> DataFrame:
    """The panel with ``resid``, the one-step error of the fitted model (NULL while warming up).

    Rows without a value are dropped first; a series too short to fit has no rows.
    """
    terms = Terms.of(order, seasonal)

    def residuals(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["value"]).sort_values("ts")
        fit = fit_terms(pdf["value"].to_numpy(dtype=float), terms)
        if fit is None:
            return pd.DataFrame(columns=["series_id", "ts", "value", "resid"])
        return pdf.assign(resid=fit.resid)

    rows = df.select("series_id", "ts", "value")
    out = rows.groupBy("series_id").applyInPandas(
        residuals, "series_id string, ts timestamp_ntz, value double, resid double"
    )
    return out.withColumn("resid", F.when(~F.isnan("resid"), F.col("resid")))


def forecast_sarima(
    df: DataFrame,
    horizon: int,
    step: Step,
    *,
    order: Order,
    seasonal: Seasonal = FLAT,
    level: float = 0.8,
    keys: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Forecasts of (p, d, q)(P, D, Q, s); a constant only without differencing.

    The interval takes quantiles of the one-step residuals, widened by the
    model's own error weights.  Series with gaps or too short have no rows;
    ``evaluate.forecast_status`` names them.
    """
    terms = Terms.of(order, seasonal)
    probs = level_probs(level)
    names = list(keys)
    columns = [*names, "origin_ts", "h", "yhat", "lower", "upper"]

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        y = pdf["value"].to_numpy(dtype=float)
        fit = None if np.isnan(y).any() else fit_terms(y, terms)
        if fit is None:
            return pd.DataFrame(columns=columns)
        path, wide = extend_series(y, fit, terms, horizon)
        lo, hi = np.quantile(fit.resid[~np.isnan(fit.resid)], probs)
        head = {k: pdf[k].iloc[0] for k in names}
        made = {"origin_ts": pdf["ts"].iloc[-1], "h": np.arange(1, horizon + 1), "yhat": path}
        return pd.DataFrame(head | made | {"lower": path + lo * wide, "upper": path + hi * wide})[columns]

    schema = f"{key_schema(df, names)}, origin_ts timestamp_ntz, h bigint, yhat double, lower double, upper double"
    rows = df.select(*names, "ts", "value").groupBy(*names).applyInPandas(forecast, schema)
    rows = rows.withColumn("ts", grid_time(grid_index(F.col("origin_ts"), step) + F.col("h"), step))
    return shape_forecast(rows, names, F.col("yhat"), F.col("lower"), F.col("upper"))


def forecast_arima(df: DataFrame, horizon: int, step: Step, *, order: Order, level: float = 0.8, **kw) -> DataFrame:
    return forecast_sarima(df, horizon, step, order=order, level=level, **kw)


def _search(y: np.ndarray, n_test: int, trials: Sequence[tuple[int, Terms]]) -> list[tuple[float, int]]:
    """(RMSE on the last ``n_test`` points, trial) of every order that can be fitted, in the order given."""
    train, test = y[:-n_test], y[-n_test:]
    out = []
    for i, terms in trials:
        fit = fit_terms(train, terms)
        if fit is not None:
            path, _ = extend_series(train, fit, terms, n_test)
            out.append((float(np.sqrt(np.mean((test - path) ** 2))), i))
    return out


def forecast_best_order(
    df: DataFrame,
    horizon: int,
    step: Step,
    *,
    orders: Sequence[tuple[Order, Seasonal]],
    n_test: int = 12,
    box_cox: float | None = None,
    level: float = 0.8,
    keys: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Search the orders on each series' last points, fit the best one again on all of them, and forecast.

    With ``box_cox`` the search and the fit see transformed values, and forecasts and limits are transformed back
    (a limit beyond the transform's range gives NULL).  ``params`` is the order taken.  Series with gaps, too
    short for every order, or not positive under the transform have no rows.
    """
    trials = [(i, Terms.of(*o)) for i, o in enumerate(orders)]
    labels = [str(o) for o in orders]
    probs = level_probs(level)
    names = list(keys)
    columns = [*names, "origin_ts", "params", "h", "yhat", "lower", "upper"]

    def back(x: np.ndarray) -> np.ndarray:
        if box_cox is None:
            return x
        if box_cox == 0:
            return np.exp(x)
        base = x * box_cox + 1
        return np.where(base > 0, np.power(np.maximum(base, 1e-300), 1 / box_cox), np.nan)

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        y = pdf["value"].to_numpy(dtype=float)
        if np.isnan(y).any() or len(y) <= n_test or (box_cox is not None and (y <= 0).any()):
            return pd.DataFrame(columns=columns)
        if box_cox is not None:
            y = np.log(y) if box_cox == 0 else (np.power(y, box_cox) - 1) / box_cox
        scores = _search(y, n_test, trials)
        if not scores:
            return pd.DataFrame(columns=columns)
        _, best = min(scores)
        terms = trials[best][1]
        fit = fit_terms(y, terms)
        path, wide = extend_series(y, fit, terms, horizon)
        lo, hi = np.quantile(fit.resid[~np.isnan(fit.resid)], probs)
        head = {k: pdf[k].iloc[0] for k in names}
        made = {"origin_ts": pdf["ts"].iloc[-1], "params": labels[best], "h": np.arange(1, horizon + 1)}
        limits = {"yhat": back(path), "lower": back(path + lo * wide), "upper": back(path + hi * wide)}
        return pd.DataFrame(head | made | limits)[columns]

    numbers = ["yhat", "lower", "upper"]
    schema = f"{key_schema(df, names)}, origin_ts timestamp_ntz, params string, h bigint, yhat double, lower double, upper double"
    rows = df.select(*names, "ts", "value").groupBy(*names).applyInPandas(forecast, schema)
    rows = rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})
    rows = rows.withColumn("ts", grid_time(grid_index(F.col("origin_ts"), step) + F.col("h"), step))
    return rows.select(*names, "h", "ts", *numbers, "origin_ts", "params")


def order_search(df: DataFrame, n_test: int, orders: Sequence[tuple[Order, Seasonal]]) -> DataFrame:
    """RMSE of every order on each series' last ``n_test`` points, with ``rank`` 1 for the best.

    The list is enumerated in full, nothing is sampled; the first order wins
    ties.  Orders a series is too short for have no row.
    """
    trials = [(i, Terms.of(*o)) for i, o in enumerate(orders)]
    labels = [str(o) for o in orders]
    columns = ["series_id", "trial", "params", "rmse"]

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        y = pdf["value"].to_numpy(dtype=float)
        found = [] if np.isnan(y).any() else _search(y, n_test, trials)
        rows = [(pdf["series_id"].iloc[0], i, labels[i], rmse) for rmse, i in found]
        return pd.DataFrame(rows, columns=columns)

    schema = "series_id string, trial int, params string, rmse double"
    table = df.select("series_id", "ts", "value").groupBy("series_id").applyInPandas(score, schema)
    best_first = Window.partitionBy("series_id").orderBy("rmse", "trial")
    return table.withColumn("rank", F.row_number().over(best_first))
