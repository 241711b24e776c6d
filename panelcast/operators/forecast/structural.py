"""Additive structural model: trend with changepoints, Fourier seasons, holidays.

Ridge weights stand for the priors.  Each tile of a series adds up its own
normal equations; only those small sums meet per series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelcast.operators.forecast.baseline import future_rows, key_schema, level_probs, shape_forecast
from panelcast.operators.ols import solve_gram
from panelcast.plans.grid import DAY, MONTH, Step, grid_index
from panelcast.plans.quantiles import bounded_quantiles
from panelcast.plans.tiles import join_series, row_tile

# Model defaults.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_PAIRS = 10
WEEKLY_PAIRS = 3
DAYS_PER_YEAR = 365.25


@dataclass(frozen=True)
class Design:
    step: Step
    changepoint_prior: float = 0.1
    season_prior: float = 1.0
    holidays: tuple[tuple[str, str], ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(sorted({name for _, name in self.holidays}))

    @property
    def weekly(self) -> bool:
        return self.step != MONTH and int(self.step) <= DAY

    def ridge(self) -> np.ndarray:
        seasons = 2 * (YEARLY_PAIRS + (WEEKLY_PAIRS if self.weekly else 0)) + len(self.names)
        return np.array(
            [0.0, 0.0]
            + [1 / self.changepoint_prior**2] * CHANGEPOINTS
            + [1 / self.season_prior**2] * seasons
        )

    def matrix(self, ts: np.ndarray, index: np.ndarray, first: float, last: float) -> np.ndarray:
        """One row of regressors per time; time runs from 0 to 1 over the history."""
        t = (index - first) / max(last - first, 1)
        knots = np.linspace(0, CHANGEPOINT_RANGE, CHANGEPOINTS + 1)[1:]
        columns = [np.ones_like(t), t, *[np.maximum(0.0, t - c) for c in knots]]
        days = (ts - np.datetime64("1970-01-01")) / np.timedelta64(1, "D")
        seasons = [(DAYS_PER_YEAR, YEARLY_PAIRS)] + ([(7.0, WEEKLY_PAIRS)] if self.weekly else [])
        for length, pairs in seasons:
            for k in range(1, pairs + 1):
                angle = 2 * np.pi * k * days / length
                columns += [np.sin(angle), np.cos(angle)]
        dates = ts.astype("datetime64[D]")
        for name in self.names:
            hit = np.array([d for d, n in self.holidays if n == name], dtype="datetime64[D]")
            columns.append(np.isin(dates, hit).astype(float))
        return np.column_stack(columns)


def fit_structural(df: DataFrame, design: Design, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Per group: ``beta`` (for values divided by ``scale``), ``first``, ``last``, ``origin_ts``; none without a value."""
    names = list(keys)
    index = grid_index(F.col("ts"), design.step)
    span = df.groupBy(*names).agg(
        F.min(index).alias("first"),
        F.max(index).alias("last"),
        F.max("ts").alias("origin_ts"),
        F.greatest(F.max(F.abs("value")), F.lit(1e-12)).alias("scale"),
    )
    known = df.where(F.col("value").isNotNull())
    rows = row_tile(join_series(known, span, keys=names), design.step).withColumn("_i", index)
    ends = [*names, "first", "last", "origin_ts", "scale"]

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        x = design.matrix(
            pdf["ts"].to_numpy(), pdf["_i"].to_numpy(dtype=float), pdf["first"].iloc[0], pdf["last"].iloc[0]
        )
        y = pdf["value"].to_numpy(dtype=float) / pdf["scale"].iloc[0]
        head = pdf[ends].iloc[:1].reset_index(drop=True)
        return head.assign(gram=[(x.T @ x).ravel().tolist()], moments=[(x.T @ y).tolist()], yy=float(y @ y), n=len(y))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        gram = np.sum([np.asarray(g) for g in pdf["gram"]], axis=0)
        moments = np.sum([np.asarray(m) for m in pdf["moments"]], axis=0)
        k = len(moments)
        beta, _, _, sse = solve_gram(gram.reshape(k, k), moments, pdf["yy"].sum(), pdf["n"].sum(), design.ridge())
        head = pdf[ends].iloc[:1].reset_index(drop=True)
        return head.assign(beta=[beta.tolist()], sse=sse, n=int(pdf["n"].sum()))

    head = f"{key_schema(df, names)}, first bigint, last bigint, origin_ts timestamp_ntz, scale double"
    parts = rows.select(*names, "_tile", "ts", "value", "_i", "first", "last", "origin_ts", "scale")
    return (
        parts.groupBy(*names, "_tile")
        .applyInPandas(sums, f"{head}, gram array<double>, moments array<double>, yy double, n bigint")
        .groupBy(*names)
        .applyInPandas(merge, f"{head}, beta array<double>, sse double, n bigint")
    )


def forecast_structural(
    df: DataFrame,
    horizon: int,
    step: Step,
    *,
    changepoint_prior: float = 0.1,
    season_prior: float = 1.0,
    holidays: Sequence[tuple[str, str]] = (),
    level: float = 0.8,
    keys: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Forecast with the interval of in-sample residual quantiles.

    ``holidays`` are (yyyy-MM-dd, name) pairs, past and future; one weight per name.
    """
    names = list(keys)
    design = Design(step, changepoint_prior, season_prior, tuple(holidays))
    fit = fit_structural(df, design, names)

    @F.pandas_udf("double")
    def fitted(
        ts: pd.Series, i: pd.Series, first: pd.Series, last: pd.Series, scale: pd.Series, beta: pd.Series
    ) -> pd.Series:
        out = np.empty(len(ts))
        ends = list(zip(first, last, scale))
        cuts = [0, *[j for j in range(1, len(ts)) if ends[j] != ends[j - 1]], len(ts)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            lo, hi, unit = ends[a]
            x = design.matrix(ts.to_numpy()[a:b], i.to_numpy(dtype=float)[a:b], lo, hi)
            stack = np.vstack(beta.iloc[a:b].to_numpy())
            out[a:b] = np.einsum("ij,ij->i", x, stack) * unit
        return pd.Series(out)

    def predict(rows: DataFrame) -> DataFrame:
        index = grid_index(F.col("ts"), step)
        return rows.withColumn("_f", fitted("ts", index, "first", "last", "scale", "beta"))

    weights = fit.select(*names, "first", "last", "scale", "beta", "origin_ts")
    past = predict(join_series(df, weights, keys=names))
    q = past.groupBy(*names).agg(bounded_quantiles(F.col("value") - F.col("_f"), level_probs(level)).alias("_q"))
    ahead = predict(future_rows(weights, horizon, step))
    y = F.col("_f")
    return shape_forecast(ahead.join(q, names), names, y, y + F.col("_q")[0], y + F.col("_q")[1])
