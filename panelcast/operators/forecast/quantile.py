"""Quantile regression on the calendar, for series of which a level matters more than the mean.

Each level minimises the pinball loss over constant and Fourier terms of the day and the week.  The loss is bounded from
above by a weighted square that touches it at the present residuals (Hunter and Lange, 2000), so each round is a
regression with weights 1 / (e + |residual|): tasks add up the weighted product sums of their rows for every series and
level, and only those small sums meet.  Coefficients are written after each round; rows never move.
The rounds begin where a sample of each series ends; if no series is longer than its sample, nothing is left to do.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelcast.operators.forecast.baseline import future_rows, level_probs, shape_forecast
from panelcast.plans.grid import Step
from panelcast.plans.tiles import join_series
from panelcast.session import shared_dir

DAY_PAIRS, WEEK_PAIRS = 3, 2
#: Rows of a series, about, that its first coefficients come from: those whose times have the smallest hashes.
SAMPLE_ROWS = 2_000
#: Rounds at most; the part of a series' deviation below which residuals are weighted alike goes from FIRST to LAST.
ROUNDS, FIRST, SHRINK, LAST = 25, 0.05, 0.7, 1e-5
#: Largest change of any fitted level, in deviations of its series, that ends the rounds.
SETTLED = 1e-4


def calendar_matrix(ts: np.ndarray) -> np.ndarray:
    """Constant, then sine and cosine of the day's and the week's phase."""
    hours = (ts - np.datetime64("2000-01-03")) / np.timedelta64(1, "h")  # a Monday
    columns = [np.ones(len(ts))]
    for length, pairs in ((24.0, DAY_PAIRS), (168.0, WEEK_PAIRS)):
        for k in range(1, pairs + 1):
            columns += [np.sin(2 * np.pi * k * hours / length), np.cos(2 * np.pi * k * hours / length)]
    return np.column_stack(columns)


def _round(x: np.ndarray, y: np.ndarray, beta: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted product sums for each level's next coefficients."""
    w = 1 / (width + np.abs(y[:, None] - x @ beta.T))
    return np.einsum("nl,ni,nj->lij", w, x, x, optimize=True), (w * y[:, None]).T @ x


def _next(gram: np.ndarray, moments: np.ndarray, ones: np.ndarray, probs: np.ndarray) -> np.ndarray:
    return np.array([np.linalg.pinv(g, hermitian=True) @ (m + (2 * p - 1) * ones) for g, m, p in zip(gram, moments, probs)])


def _from_sample(probs: np.ndarray):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = calendar_matrix(pdf["ts"].to_numpy())
        y = ((pdf["value"] - pdf["mean"]) / pdf["scale"]).to_numpy()
        beta = np.zeros((len(probs), x.shape[1]))
        for i in range(150):
            beta = _next(*_round(x, y, beta, max(0.3 * 0.88**i, 1e-7)), x.sum(axis=0), probs)
        return pdf[["series_id", "n", "mean", "scale"]].iloc[:1].assign(beta=[beta.ravel()])

    return fit


def fit_quantile_regression(df: DataFrame, probs: Sequence[float], *, rounds: int = ROUNDS) -> DataFrame:
    """``series_id, mean, scale, beta``: for each of ``probs`` (rising) its coefficients, of values less ``mean`` over ``scale``.

    Rows without a value take no part; a series without any has no row; a constant one is fitted by its value.
    """
    probs = np.asarray(sorted(probs), dtype=float)
    k, levels = 1 + 2 * (DAY_PAIRS + WEEK_PAIRS), len(probs)
    rows = df.where(F.col("value").isNotNull()).select("series_id", "ts", F.col("value").cast("double").alias("value"))
    scale = F.coalesce(F.nullif(F.stddev_pop("value"), F.lit(0.0)), F.lit(1.0))
    unit = rows.groupBy("series_id").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), scale.alias("scale"))
    place = F.pmod(F.xxhash64("series_id", "ts"), F.lit(1 << 40)) / float(1 << 40)
    sample = join_series(rows, unit).where(place * F.col("n") < SAMPLE_ROWS)
    held = _written(sample.groupBy("series_id").applyInPandas(_from_sample(probs), "series_id string, n bigint, mean double, scale double, beta array<double>"))
    # Series that are their own sample are done.
    done, held = held.where(F.col("n") <= SAMPLE_ROWS), held.where(F.col("n") > SAMPLE_ROWS)
    if held.isEmpty():
        rounds = 0

    def parts(width: float):
        def run(batches):
            sums: dict = {}
            for pdf in batches:
                x = calendar_matrix(pdf["ts"].to_numpy())
                y = ((pdf["value"] - pdf["mean"]) / pdf["scale"]).to_numpy()
                for sid, at in pdf.groupby("series_id", sort=False).indices.items():
                    beta = np.asarray(pdf["beta"].iloc[at[0]]).reshape(levels, k)
                    own, target = x[at], y[at]
                    gram, moments = _round(own, target, beta, width)
                    new = np.concatenate([gram.ravel(), moments.ravel(), own.sum(axis=0)])
                    sums[sid] = new if sid not in sums else sums[sid] + new
                if len(sums) >= 2_000:
                    yield pd.DataFrame({"series_id": list(sums), "sums": list(sums.values())})
                    sums = {}
            if sums:
                yield pd.DataFrame({"series_id": list(sums), "sums": list(sums.values())})

        return run

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.array(pdf["sums"].tolist()), axis=0)
        gram, moments, ones = np.split(total, [levels * k * k, levels * k * (k + 1)])
        gram, moments = gram.reshape(levels, k, k), moments.reshape(levels, k)
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[:1], "new": [_next(gram, moments, ones, probs).ravel()]})

    for i in range(rounds):
        width = max(FIRST * SHRINK**i, LAST)
        sums = join_series(rows, held.select("series_id", "mean", "scale", "beta")).mapInPandas(parts(width), "series_id string, sums array<double>")
        made = sums.groupBy("series_id").applyInPandas(solve, "series_id string, new array<double>")
        moved = F.array_max(F.transform(F.arrays_zip("new", "beta"), lambda z: F.abs(z["new"] - z["beta"])))
        step = join_series(held, made).select("series_id", "n", "mean", "scale", F.col("new").alias("beta"), moved.alias("moved"))
        held = _written(step)
        # One number ends the rounds.
        if width == LAST and (held.agg(F.max("moved")).first()[0] or 0.0) < SETTLED:
            break
    cut = F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda i: F.slice("beta", i * k + 1, F.lit(k)))
    return done.unionByName(held.select(*done.columns)).select("series_id", "mean", "scale", cut.alias("beta"))


def _written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "quantile-regression")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def predict_quantiles(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Add ``q``: the levels of :func:`fit_quantile_regression` at each row's time, in rising order."""

    @F.pandas_udf("array<double>")
    def levels(ts: pd.Series, mean: pd.Series, scale: pd.Series, beta: pd.Series) -> pd.Series:
        x = calendar_matrix(ts.to_numpy())
        b = np.array([np.vstack(list(rows)) for rows in beta]).reshape(len(ts), -1, x.shape[1])
        q = np.einsum("nk,nlk->nl", x, b) * scale.to_numpy()[:, None] + mean.to_numpy()[:, None]
        # Levels fitted one by one may cross; in order, none is worse off.
        return pd.Series(list(np.sort(q, axis=1)))

    return join_series(rows, fit).withColumn("q", levels("ts", "mean", "scale", "beta")).drop("mean", "scale", "beta")


def forecast_quantile_regression(df: DataFrame, horizon: int, step: Step, *, level: float = 0.8) -> DataFrame:
    """Median and interval of the regressions at the times ahead; the interval holds the median."""
    lo, hi = level_probs(level)
    fit = fit_quantile_regression(df, [lo, 0.5, hi])
    last = df.groupBy("series_id").agg(F.max("ts").alias("origin_ts"))
    rows = predict_quantiles(future_rows(last, horizon, step), fit)
    return shape_forecast(rows, ["series_id"], F.col("q")[1], F.col("q")[0], F.col("q")[2])


def pinball_balance(df: DataFrame, probs: Sequence[float], fit: DataFrame, *, near: float = 1e-3) -> DataFrame:
    """Per series and level: is the fit a minimum of the pinball loss?

    There, no direction pays: for each regressor the balance of rows above (weight p) and below (1 - p) is outweighed by
    the rows that the fit goes through, those within ``near`` deviations.  ``share`` is the share of rows below.
    """
    probs = [float(p) for p in sorted(probs)]

    def run(batches):
        for pdf in batches:
            x = calendar_matrix(pdf["ts"].to_numpy())
            b = np.array([np.vstack(list(rows)) for rows in pdf["beta"]]).reshape(len(pdf), -1, x.shape[1])
            r = ((pdf["value"] - pdf["mean"]) / pdf["scale"]).to_numpy()[:, None] - np.einsum("nk,nlk->nl", x, b)
            on = np.abs(r) <= near
            for j, p in enumerate(probs):
                pull = np.where(on[:, j], 0.0, np.where(r[:, j] > 0, p, p - 1))
                made = {"series_id": pdf["series_id"], "prob": p, "pull": list(x * pull[:, None]), "hold": list(np.abs(x) * on[:, j : j + 1]), "below": (r[:, j] < 0).astype(int)}
                yield pd.DataFrame(made)

    schema = "series_id string, prob double, pull array<double>, hold array<double>, below int"
    rows = join_series(df.where(F.col("value").isNotNull()), fit).select("series_id", "ts", "value", "mean", "scale", "beta").mapInPandas(run, schema)
    k = 1 + 2 * (DAY_PAIRS + WEEK_PAIRS)
    sums = rows.groupBy("series_id", "prob").agg(
        F.array(*[F.abs(F.sum(F.col("pull")[i])) - F.sum(F.col("hold")[i]) for i in range(k)]).alias("_g"), F.avg("below").alias("share")
    )
    return sums.select("series_id", "prob", "share", (F.array_max("_g") <= 1e-6).alias("is_minimum"))
