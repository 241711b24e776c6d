"""Anomaly detectors.  All give ``series_id, ts, value, method, score, lower, upper``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelcast.operators.clean import coerce_numeric
from panelcast.operators.forecast.arima import arima_residuals
from panelcast.operators.stats import decompose, series_moments
from panelcast.operators.windows import strict_mean
from panelcast.plans.grid import Step, grid_index, grid_time
from panelcast.plans.quantiles import exact_quantiles
from panelcast.plans.tiles import attach, join_series, lag_steps, over_tiles, runs, time_tile
from panelcast.schema import select_anomaly


def _finish(df: DataFrame, method: str, score: Column, lower: Column, upper: Column) -> DataFrame:
    return select_anomaly(
        df.withColumns({"method": F.lit(method), "score": score, "lower": lower, "upper": upper})
    )


def outliers_iqr(df: DataFrame, factor: float = 1.5) -> DataFrame:
    """Values outside the quartiles by more than ``factor`` interquartile ranges.

    The score is the distance from the nearer limit in interquartile ranges.
    """
    fences = exact_quantiles(df, [0.25, 0.75]).select(
        "series_id", F.col("q")[0].alias("_q1"), F.col("q")[1].alias("_q3")
    )
    v, spread = F.col("value"), F.col("_q3") - F.col("_q1")
    lower, upper = F.col("_q1") - factor * spread, F.col("_q3") + factor * spread
    rows = attach(time_tile(df), fences).where((v < lower) | (v > upper))
    return _finish(rows, "iqr", F.try_divide(F.greatest(lower - v, v - upper), spread), lower, upper)


def outliers_zscore(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Values more than ``threshold`` population deviations from the series mean."""
    v, mean, sd = F.col("value"), F.col("_mean"), F.col("_pop")
    score = F.try_divide(v - mean, sd)
    rows = attach(time_tile(df), series_moments(df)).where(F.abs(score) > threshold)
    return _finish(rows, "zscore", score, mean - threshold * sd, mean + threshold * sd)


def outliers_decompose(df: DataFrame, step: Step, *, period: int = 50) -> DataFrame:
    """Residuals of the additive decomposition beyond two sample deviations."""
    parts = decompose(df, period, step)
    spread = parts.groupBy("series_id").agg(F.stddev_samp("resid").alias("_samp"))
    rows = join_series(parts, spread).where(F.abs("resid") > 2 * F.col("_samp"))
    centre, band = F.col("trend") + F.col("seasonal"), 2 * F.col("_samp")
    return _finish(rows, "decompose", F.try_divide(F.col("resid"), F.col("_samp")), centre - band, centre + band)


def outliers_model(
    df: DataFrame, *, order: tuple[int, int, int] = (1, 1, 1), threshold: float = 3.0
) -> DataFrame:
    """One-step model residuals with a population z-score beyond ``threshold``."""
    resid = arima_residuals(coerce_numeric(df), order).where(F.col("resid").isNotNull())
    v, mean, sd = F.col("resid"), F.col("_mean"), F.col("_pop")
    score = F.try_divide(v - mean, sd)
    rows = join_series(resid, series_moments(resid, "resid")).where(F.abs(score) > threshold)
    fitted = F.col("value") - v
    return _finish(rows, "model", score, fitted + mean - threshold * sd, fitted + mean + threshold * sd)


def moving_average_band(df: DataFrame, window: int, step: Step, *, scale: float = 1.96) -> DataFrame:
    """Every row with its strict moving average, the band around it, and ``is_anomaly``.

    The band's half width is the mean absolute error plus ``scale`` population
    deviations of value minus average, over the rows after the first ``window``.
    """
    v = F.col("value")

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {"ma": strict_mean(v, w, window), "_late": F.lag(F.lit(1), window).over(w)}

    rows = over_tiles(df, columns, step=step, back=window)
    off = F.when(F.col("_late") == 1, v - F.col("ma"))
    widths = rows.groupBy("series_id").agg(
        (F.avg(F.abs(off)) + scale * F.stddev_pop(off)).alias("_width")
    )
    lower, upper = F.col("ma") - F.col("_width"), F.col("ma") + F.col("_width")
    flag = F.col("ma").isNotNull() & ((v < lower) | (v > upper))
    return join_series(rows, widths).select(
        "series_id", "ts", "value", "ma", lower.alias("lower"), upper.alias("upper"), flag.alias("is_anomaly")
    )


def outliers_band(df: DataFrame, window: int, step: Step, *, scale: float = 1.96) -> DataFrame:
    rows = moving_average_band(df, window, step, scale=scale).where("is_anomaly")
    half = F.col("upper") - F.col("ma")
    return select_anomaly(
        rows.withColumns({"method": F.lit("band"), "score": F.try_divide(F.col("value") - F.col("ma"), half)})
    )


DETECTORS = {
    "iqr": lambda df, step, period: outliers_iqr(df),
    "zscore": lambda df, step, period: outliers_zscore(df),
    "decompose": lambda df, step, period: outliers_decompose(df, step, period=period),
    "model": lambda df, step, period: outliers_model(df),
    "band": lambda df, step, period: outliers_band(df, period, step),
}


def detect_all(
    df: DataFrame,
    step: Step,
    *,
    period: int = 50,
    methods: Sequence[str] = ("iqr", "zscore", "decompose", "model"),
    order: tuple[int, int, int] = (1, 1, 1),
) -> DataFrame:
    """The findings of several detectors in one long table; ``order`` is the model detector's.

    A series a method cannot handle (too short, constant) has no rows from it.
    Persist ``df`` first if it is costly: each method reads it on its own.
    """
    parts = [outliers_model(df, order=order) if m == "model" else DETECTORS[m](df, step, period) for m in methods]
    return reduce(DataFrame.unionByName, parts)


def count_by_method(found: DataFrame) -> DataFrame:
    return found.groupBy("method").agg(F.count(F.lit(1)).alias("n_anomalies"))


def with_residuals(actuals: DataFrame, forecast: DataFrame) -> DataFrame:
    """Actual values with their forecast and ``resid`` = actual - forecast, joined on series and time."""
    f = forecast.select(F.col("asset_id").alias("series_id"), F.col("timestamp").alias("ts"), "yhat", "lower", "upper")
    return actuals.select("series_id", "ts", "value").join(f, ["series_id", "ts"]).withColumn(
        "resid", F.col("value") - F.col("yhat")
    )


def residual_anomalies(actuals: DataFrame, forecast: DataFrame, k: float = 3.0) -> DataFrame:
    """Actuals outside the forecast interval, or with a residual z-score beyond ``k``."""
    rows = with_residuals(actuals, forecast)
    t = join_series(rows, series_moments(rows, "resid"))
    z = F.try_divide(F.col("resid") - F.col("_mean"), F.col("_pop"))
    v = F.col("value")
    out = (v < F.col("lower")) | (v > F.col("upper")) | (F.abs(z) > k)
    return select_anomaly(t.where(out).withColumns({"method": F.lit("residual"), "score": z}))


def _run_table(rows: DataFrame, flag: Column, step: Step, min_run: int) -> DataFrame:
    numbered = runs(rows, flag, step=step).where(flag)
    end = grid_time(grid_index(F.max("ts"), step) + 1, step)
    return (
        numbered.groupBy("series_id", "run")
        .agg(
            F.min("ts").alias("start_ts"),
            end.alias("end_ts"),
            F.count(F.lit(1)).alias("n_steps"),
            F.avg("value").alias("mean_value"),
        )
        .where(F.col("n_steps") >= min_run)
        .drop("run")
    )


def persistent_residuals(residuals: DataFrame, step: Step, *, min_run: int = 6) -> DataFrame:
    """Runs of at least ``min_run`` steps whose residuals keep one sign."""
    sign = F.signum("resid").cast("int")
    numbered = runs(residuals, sign, step=step).where(sign != 0)
    end = grid_time(grid_index(F.max("ts"), step) + 1, step)
    return (
        numbered.groupBy("series_id", "run")
        .agg(
            F.min("ts").alias("start_ts"),
            end.alias("end_ts"),
            F.count(F.lit(1)).alias("n_steps"),
            F.min(sign).cast("bigint").alias("direction"),
            F.avg("resid").alias("mean_resid"),
        )
        .where(F.col("n_steps") >= min_run)
        .drop("run")
    )


def residual_drift(residuals: DataFrame, step: Step, *, window: int) -> DataFrame:
    """Residuals of the last ``window`` steps against all earlier ones.

    Means, sample deviations, their ratio, and the Kolmogorov-Smirnov distance
    of the two distributions, from counts per value.  Residuals are regular, so
    a series is at most one row per step; one shuffle serves all steps below.
    """
    series = Window.partitionBy("series_id")
    recent = grid_index(F.col("ts"), step) > F.max(grid_index(F.col("ts"), step)).over(series) - window
    rows = residuals.select("series_id", "resid", recent.alias("_recent")).where(F.col("resid").isNotNull())
    counts = rows.groupBy("series_id", "resid").agg(
        F.count_if("_recent").alias("_a"), F.count_if(~F.col("_recent")).alias("_b")
    )
    r, a, b = F.col("resid"), F.col("_a"), F.col("_b")
    totals = counts.withColumns(
        {
            "n_recent": F.sum(a).over(series),
            "n_earlier": F.sum(b).over(series),
            "mean_recent": F.try_divide(F.sum(a * r).over(series), F.sum(a).over(series)),
            "mean_earlier": F.try_divide(F.sum(b * r).over(series), F.sum(b).over(series)),
        }
    )
    upto = series.orderBy("resid").rowsBetween(Window.unboundedPreceding, 0)
    share_new = F.try_divide(F.sum(a).over(upto), F.col("n_recent"))
    share_old = F.try_divide(F.sum(b).over(upto), F.col("n_earlier"))
    spread = totals.withColumn("_d", F.abs(share_new - share_old))

    def deviation(count: Column, mean: str, n: str) -> Column:
        off = r - F.col(mean)
        return F.sqrt(F.try_divide(F.sum(count * off * off), F.max(n) - 1))

    table = spread.groupBy("series_id", "n_recent", "n_earlier", "mean_recent", "mean_earlier").agg(
        deviation(a, "mean_recent", "n_recent").alias("std_recent"),
        deviation(b, "mean_earlier", "n_earlier").alias("std_earlier"),
        F.max("_d").alias("ks"),
    )
    return table.withColumn("std_ratio", F.try_divide("std_recent", "std_earlier"))


def unexpected_ramps(residuals: DataFrame, step: Step, *, k: float) -> DataFrame:
    """Steps where the actual ramp differs from the forecast ramp by more than ``k``; no ramp leads over a gap."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {
            "actual_ramp": F.col("value") - lag_steps("value", 1, w),
            "forecast_ramp": F.col("yhat") - lag_steps("yhat", 1, w),
        }

    rows = over_tiles(residuals, columns, step=step, back=1)
    return rows.where(F.abs(F.col("actual_ramp") - F.col("forecast_ramp")) > k).select(
        "series_id", "ts", "actual_ramp", "forecast_ramp"
    )


def outages(residuals: DataFrame, step: Step, *, eps: float, k: float, min_run: int = 1) -> DataFrame:
    """Runs where the actual value is near zero while more than ``k`` was forecast."""
    flag = (F.abs("value") < eps) & (F.col("yhat") > k)
    return _run_table(residuals, F.coalesce(flag, F.lit(False)), step, min_run)


def stuck_sensor(df: DataFrame, step: Step, *, min_run: int) -> DataFrame:
    """Runs of at least ``min_run`` steps with one unchanged value."""
    numbered = runs(df, F.col("value"), step=step).where(F.col("value").isNotNull())
    end = grid_time(grid_index(F.max("ts"), step) + 1, step)
    return (
        numbered.groupBy("series_id", "run")
        .agg(
            F.min("ts").alias("start_ts"),
            end.alias("end_ts"),
            F.count(F.lit(1)).alias("n_steps"),
            F.min("value").alias("value"),
        )
        .where(F.col("n_steps") >= min_run)
        .drop("run")
    )
