"""Vector autoregression: a few series forecast together."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelcast.operators.forecast.baseline import level_probs, shape_forecast
from panelcast.operators.ols import linear_predictor, ols_fit
from panelcast.plans.grid import Step, grid_index, grid_time
from panelcast.plans.quantiles import bounded_quantiles
from panelcast.plans.tiles import over_tiles
from panelcast.sources.shapes import to_wide


# Steps before the end from which the shocks are run; an invertible model has forgotten their start by then.
WARM_UP = 200


def extend_system(betas: np.ndarray, tail: np.ndarray, p: int, horizon: int, q: int = 0) -> np.ndarray:
    """Rows of forecasts; ``betas`` holds one equation per row: constant, lags nearest first, shocks nearest first.

    With ``q`` the shocks are the model's own one-step errors along ``tail``, zero before it.
    """
    rows, shocks = [r for r in tail], [np.zeros(len(betas)) for _ in tail]

    def step() -> np.ndarray:
        t = len(shocks)
        return betas @ np.concatenate([[1.0], *[rows[t - k] for k in range(1, p + 1)], *[shocks[t - k] for k in range(1, q + 1)]])

    if q:
        del shocks[max(p, q) :]
        while len(shocks) < len(tail):
            shocks.append(rows[len(shocks)] - step())
    for _ in range(horizon):
        rows.append(step())
        shocks.append(np.zeros(len(betas)))
    return np.array(rows[len(tail) :])


def _equations(design: DataFrame, cols: Sequence[str], xs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(one fitted equation per row, its one-step errors): every column regressed on all of ``xs``."""
    targets = F.explode(
        F.array(*[F.struct(F.lit(i).alias("eq"), F.col(c).alias("target")) for i, c in enumerate(cols)])
    )
    long = design.select("ts", *xs, targets.alias("_q")).select("ts", *xs, "_q.eq", "_q.target")
    fit = ols_fit(long, xs, "target", keys=["eq"]).select("eq", "beta")
    errors = F.col("target") - linear_predictor(F.col("beta"), xs)
    return fit, long.join(F.broadcast(fit), "eq").withColumn("_r", errors)


def forecast_var(
    df: DataFrame, series: Sequence[str], horizon: int, step: Step, *, p: int = 2, q: int = 0, level: float = 0.8
) -> DataFrame:
    """VAR(p) with a constant over the named series, each equation by least squares.

    The names are given, so their number is small by construction: the system
    has (number of series)^2 * (p + q) coefficients.  One wide design row per
    time serves all equations.  ``q`` adds moving-average terms in two stages:
    the errors of a longer autoregression stand for the shocks.
    """
    names = list(series)
    cols = [f"_y{i}" for i in range(len(names))]
    wide = to_wide(df.where(F.col("series_id").isin(names)), names)
    wide = wide.select(F.lit("all").alias("_g"), "ts", *[F.col(f"`{n}`").alias(c) for n, c in zip(names, cols)])

    def lagged(rows: DataFrame, lags: dict[str, int], keep: int) -> tuple[DataFrame, list[str]]:
        """Columns of past values, nearest first; ``_after`` is NULL in the last ``keep`` rows."""
        deep = max(lags.values())
        pairs = [(c, k) for k in range(1, deep + 1) for c in lags if k <= lags[c]]
        past = sorted(pairs, key=lambda x: (x[0].startswith("_e"), x[1], x[0]))
        design = over_tiles(
            rows,
            lambda w: {f"_l{k}_{c}": F.lag(c, k).over(w) for c, k in past} | {"_after": F.lead(F.lit(1), keep).over(w)},
            step=step,
            back=deep,
            ahead=keep,
            keys=["_g"],
        )
        return design, [f"_l{k}_{c}" for c, k in past]

    keep = p
    if q:
        keep = WARM_UP + max(p, q)
        first, xs = lagged(wide, dict.fromkeys(cols, p + q + 3), 1)
        _, errors = _equations(first, cols, xs)
        shocks = [F.max(F.when(F.col("eq") == i, F.col("_r"))).alias(f"_e{i}") for i in range(len(cols))]
        wide = wide.join(errors.groupBy("ts").agg(*shocks), "ts", "left")
    design, xs = lagged(wide, dict.fromkeys(cols, p) | ({f"_e{i}": q for i in range(len(cols))} if q else {}), keep)
    fit, resid = _equations(design, cols, xs)
    spread = resid.groupBy("eq").agg(bounded_quantiles(F.col("_r"), level_probs(level)).alias("_q"))
    system = fit.agg(F.array_sort(F.collect_list(F.struct("eq", "beta"))).alias("_b"))
    tail = design.where(F.col("_after").isNull()).agg(
        F.max("ts").alias("origin_ts"),
        F.array_sort(F.collect_list(F.struct("ts", F.array(*cols).alias("y")))).alias("_t"),
    )

    @F.pandas_udf("array<array<double>>")
    def recurse(betas: pd.Series, rows: pd.Series) -> pd.Series:
        out = []
        for b, t in zip(betas, rows):
            system = np.array([np.asarray(x, dtype=float) for x in b])
            newest = np.array([np.asarray(x, dtype=float) for x in t])
            out.append([r.tolist() for r in extend_system(system, newest, p, horizon, q)])
        return pd.Series(out)

    path = system.crossJoin(F.broadcast(tail)).withColumn(
        "_f", recurse(F.transform("_b", lambda r: r["beta"]), F.transform("_t", lambda r: r["y"]))
    )
    steps = path.select("origin_ts", F.posexplode("_f").alias("_p", "_row")).select(
        "origin_ts", "_p", F.posexplode("_row").alias("eq", "_v")
    )
    labels = F.array(*[F.lit(n) for n in names])
    rows = steps.join(F.broadcast(spread), "eq").withColumns(
        {"series_id": labels[F.col("eq")], "h": (F.col("_p") + 1).cast("bigint")}
    )
    rows = rows.withColumn("ts", grid_time(grid_index(F.col("origin_ts"), step) + F.col("h"), step))
    y = F.col("_v")
    return shape_forecast(rows, ["series_id"], y, y + F.col("_q")[0], y + F.col("_q")[1])
