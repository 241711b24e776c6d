"""Lag, rolling and prefix features of a regular panel.

All positions are rows, so ``regularize`` comes first.  Windows of finite reach
run on tiles; the running statistics merge per-tile moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelcast.functions.calendar import time_features
from panelcast.plans.grid import Step, grid_index, grid_time
from panelcast.plans.tiles import TILE_ROWS, over_tiles, row_tile

# Lags and windows of the half-hourly and of the hourly forest features.
HALF_HOUR_LAGS = [1, 2, 3, 48, 96, 336, 672, 1008]
HALF_HOUR_WINDOWS = [3, 6, 12, 48, 96, 336, 672, 1008]
HOURLY_LAGS = [1, 2, 3, 24]
HOURLY_WINDOWS = [3, 6, 12, 24]


def mean_before(value: Column, w: WindowSpec, size: int) -> Column:
    """Mean of the ``size`` rows before the current one."""
    return F.avg(value).over(w.rowsBetween(-size, -1))


def strict_mean(value: Column, w: WindowSpec, size: int) -> Column:
    """Mean of the current and the ``size - 1`` rows before it; NULL until all are known."""
    frame = w.rowsBetween(1 - size, 0)
    return F.when(F.count(value).over(frame) == size, F.avg(value).over(frame))


def nth_difference(value: Column, w: WindowSpec, n: int, lag: int = 1) -> Column:
    """n-th difference at distance ``lag``, as one signed sum of lags."""
    out = value
    for k in range(1, n + 1):
        out = out + (-1) ** k * comb(n, k) * F.lag(value, k * lag).over(w)
    return out


def lag_features(df: DataFrame, lags: Sequence[int], step: Step) -> DataFrame:
    v = F.col("value")
    return over_tiles(
        df, lambda w: {f"lag_{k}": F.lag(v, k).over(w) for k in lags}, step=step, back=max(lags)
    )


def rolling_mean_features(df: DataFrame, windows: Sequence[int], step: Step) -> DataFrame:
    """Mean of the points before the current one, so that no target leaks in."""
    v = F.col("value")
    return over_tiles(
        df, lambda w: {f"rmean_{k}": mean_before(v, w, k) for k in windows}, step=step, back=max(windows)
    )


def rolling_means(df: DataFrame, windows: Sequence[int], step: Step, *, min_periods: int | None = None) -> DataFrame:
    """Rolling means that include the current row, one column ``ma_<w>`` per window.

    Without ``min_periods`` a mean is NULL until its window is full.
    """
    v = F.col("value")

    def mean(w: WindowSpec, k: int) -> Column:
        if min_periods is None:
            return strict_mean(v, w, k)
        frame = w.rowsBetween(1 - k, 0)
        return F.when(F.count(v).over(frame) >= min_periods, F.avg(v).over(frame))

    return over_tiles(df, lambda w: {f"ma_{k}": mean(w, k) for k in windows}, step=step, back=max(windows))


def rolling_mean(df: DataFrame, window: int, step: Step, *, min_periods: int | None = None) -> DataFrame:
    return rolling_means(df, [window], step, min_periods=min_periods).withColumnRenamed(
        f"ma_{window}", "rolling_mean"
    )


def difference(df: DataFrame, step: Step, *, n: int = 1, seasonal: int | None = None) -> DataFrame:
    """Add ``diff``: the n-th difference, after one seasonal difference if a period is given."""
    v = F.col("value")
    if seasonal is None:
        return over_tiles(df, lambda w: {"diff": nth_difference(v, w, n)}, step=step, back=n)
    s = over_tiles(df, lambda w: {"_s": nth_difference(v, w, 1, seasonal)}, step=step, back=seasonal)
    if n == 0:
        return s.withColumnRenamed("_s", "diff")
    return over_tiles(s, lambda w: {"diff": nth_difference(F.col("_s"), w, n)}, step=step, back=n).drop("_s")


def prefix_stats(df: DataFrame, step: Step, *, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Add ``prefix_mean`` and ``prefix_var`` (population) of the points strictly before each row.

    First row NULL.  Each tile runs its own window; the moments of all earlier
    tiles arrive as one row and are merged with the parallel variance formula.
    """
    t = row_tile(df, step, tile_rows)
    tiles = t.groupBy("series_id", "_tile").agg(
        F.count("value").alias("_n"), F.avg("value").alias("_m"), F.var_pop("value").alias("_v")
    )
    earlier = Window.partitionBy("series_id").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    # Square sums are taken around the series' first tile mean: no loss of digits.
    tiles = tiles.withColumn(
        "_c", F.first("_m", ignorenulls=True).over(Window.partitionBy("series_id").orderBy("_tile"))
    )
    tiles = tiles.withColumn("_c", F.max("_c").over(Window.partitionBy("series_id")))
    shift = F.col("_m") - F.col("_c")
    n0 = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    s0 = F.sum(F.col("_n") * shift).over(earlier)
    q0 = F.sum(F.col("_n") * (F.col("_v") + shift * shift)).over(earlier)
    heads = tiles.select(
        "series_id",
        "_tile",
        n0.alias("_n0"),
        (F.col("_c") + F.try_divide(s0, n0)).alias("_m0"),
        (q0 - F.try_divide(s0 * s0, n0)).alias("_q0"),
    )
    frame = (
        Window.partitionBy("series_id", "_tile").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = t.join(heads, ["series_id", "_tile"]).withColumns(
        {
            "_n1": F.count("value").over(frame),
            "_m1": F.coalesce(F.avg("value").over(frame), F.lit(0.0)),
            "_v1": F.coalesce(F.var_pop("value").over(frame), F.lit(0.0)),
        }
    )
    n1 = F.col("_n1")
    n = F.col("_n0") + n1
    m0, q0c = F.coalesce("_m0", F.lit(0.0)), F.coalesce("_q0", F.lit(0.0))
    gap = F.col("_m1") - m0
    mean = m0 + F.try_divide(gap * n1, n)
    squares = q0c + F.col("_v1") * n1 + F.try_divide(gap * gap * F.col("_n0") * n1, n)
    return joined.select(
        *df.columns,
        F.when(n > 0, mean).alias("prefix_mean"),
        F.when(n > 0, F.greatest(F.try_divide(squares, n), F.lit(0.0))).alias("prefix_var"),
    )


def rolling_rmse(errors: DataFrame, step: Step, window: int = 12) -> DataFrame:
    """Root mean square of the last ``window`` one-step errors; NULL until the window is full."""
    one = errors.where(F.col("horizon") == 1)
    e2 = F.col("error") * F.col("error")
    return over_tiles(
        one,
        lambda w: {"rolling_rmse": F.sqrt(strict_mean(e2, w, window))},
        step=step,
        back=window,
        keys=_eval_keys(errors),
    )


def rolling_mape(errors: DataFrame, step: Step, window: int = 12) -> DataFrame:
    """Mean absolute relative error as a fraction, over the last ``window`` one-step errors."""
    one = errors.where(F.col("horizon") == 1)
    rel = F.abs(F.try_divide(F.col("error"), F.col("actual")))
    return over_tiles(
        one,
        lambda w: {"rolling_mape": strict_mean(rel, w, window)},
        step=step,
        back=window,
        keys=_eval_keys(errors),
    )


def _eval_keys(errors: DataFrame) -> list[str]:
    return ["series_id", "model"] if "model" in errors.columns else ["series_id"]


def feature_matrix(df: DataFrame, step: Step, *, lags: Sequence[int], windows: Sequence[int]) -> DataFrame:
    """Lags, rolling means before the row, hour and day of week, and the target ``y``.

    The first max(lag, window) rows of a series are left out.  One shuffle.
    """
    reach = max(*lags, *windows)
    v = F.col("value")

    def columns(w: WindowSpec) -> dict[str, Column]:
        out = {f"lag_{k}": F.lag(v, k).over(w) for k in lags}
        out |= {f"rmean_{k}": mean_before(v, w, k) for k in windows}
        out["_warm"] = F.lag(F.lit(1), reach).over(w)
        return out

    calendar = time_features(F.col("ts"))
    rows = over_tiles(df, columns, step=step, back=reach).where(F.col("_warm") == 1)
    return rows.select(
        "series_id",
        "ts",
        *[f"lag_{k}" for k in lags],
        *[f"rmean_{k}" for k in windows],
        calendar["hour"].alias("hour"),
        calendar["dow"].alias("dow"),
        v.alias("y"),
    )


def future_frame(df: DataFrame, periods: int, step: Step) -> DataFrame:
    """The next ``periods`` timestamps after each series' last one."""
    last = df.groupBy("series_id").agg(grid_index(F.max("ts"), step).alias("_last"))
    h = F.explode(F.sequence(F.lit(1), F.lit(periods)))
    rows = last.select("series_id", "_last", h.alias("h"))
    return rows.select("series_id", F.col("h").cast("bigint").alias("h"), grid_time(F.col("_last") + F.col("h"), step).alias("ts"))
