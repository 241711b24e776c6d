"""Mean, naive, seasonal naive and empirical-quantile forecasts.

Input is a regular panel, so a group holds at most one value per grid step;
that is the bound for the residual quantiles taken per group here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from panelcast.functions.calendar import time_features
from panelcast.plans.grid import Step, grid_index, grid_time
from panelcast.plans.quantiles import bounded_quantiles
from panelcast.plans.tiles import over_tiles

Keys = Sequence[str]


def level_probs(level: float) -> list[float]:
    return [(1 - level) / 2, (1 + level) / 2]


def key_schema(df: DataFrame, keys: Keys) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def future_rows(per_series: DataFrame, horizon: int, step: Step) -> DataFrame:
    """One row per future step of each group; ``origin_ts`` is the last time known."""
    last = grid_index(F.col("origin_ts"), step)
    steps = F.sequence(F.lit(1).cast("bigint"), F.lit(horizon).cast("bigint"))
    rows = per_series.withColumn("h", F.explode(steps))
    return rows.withColumn("ts", grid_time(last + F.col("h"), step))


def shape_forecast(rows: DataFrame, keys: Keys, yhat: Column, lower: Column, upper: Column) -> DataFrame:
    return rows.select(
        *keys, "h", "ts", yhat.alias("yhat"), lower.alias("lower"), upper.alias("upper"), "origin_ts"
    )


def forecast_mean(
    df: DataFrame, horizon: int, step: Step, *, keys: Keys = ("series_id",), level: float = 0.8
) -> DataFrame:
    """The mean for every step; interval from the quantiles of value minus mean."""
    q = bounded_quantiles(F.col("value"), level_probs(level))
    s = df.groupBy(*keys).agg(F.avg("value").alias("_mean"), F.max("ts").alias("origin_ts"), q.alias("_q"))
    return shape_forecast(future_rows(s, horizon, step), keys, F.col("_mean"), F.col("_q")[0], F.col("_q")[1])


def forecast_naive(
    df: DataFrame, horizon: int, step: Step, *, keys: Keys = ("series_id",), level: float = 0.8
) -> DataFrame:
    """The last value for every step; interval from one-step changes times sqrt(h)."""
    v = F.col("value")
    rows = over_tiles(df, lambda w: {"_e": v - F.lag(v, 1).over(w)}, step=step, back=1, keys=keys)
    s = rows.groupBy(*keys).agg(
        F.max_by("value", "ts").alias("_last"),
        F.max("ts").alias("origin_ts"),
        bounded_quantiles(F.col("_e"), level_probs(level)).alias("_q"),
    )
    wide = F.sqrt("h")
    yhat = F.col("_last")
    return shape_forecast(
        future_rows(s, horizon, step), keys, yhat, yhat + F.col("_q")[0] * wide, yhat + F.col("_q")[1] * wide
    )


def forecast_snaive(
    df: DataFrame, horizon: int, step: Step, *, season: int, keys: Keys = ("series_id",), level: float = 0.8
) -> DataFrame:
    """The value at the same place of the last season.

    A series shorter than a season repeats what it has.  The interval takes
    seasonal changes, widened by the square root of the seasons ahead.
    """
    v = F.col("value")

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {"_e": v - F.lag(v, season).over(w), "_after": F.lead(F.lit(1), season).over(w)}

    rows = over_tiles(df, columns, step=step, back=season, ahead=season, keys=keys)
    tail = F.when(F.col("_after").isNull(), F.struct("ts", "value"))
    s = rows.groupBy(*keys).agg(
        F.max("ts").alias("origin_ts"),
        F.array_sort(F.collect_list(tail)).alias("_tail"),
        bounded_quantiles(F.col("_e"), level_probs(level)).alias("_q"),
    )
    place = ((F.col("h") - 1) % F.size("_tail")).cast("int")
    yhat = F.get("_tail", place)["value"]
    wide = F.sqrt(F.floor((F.col("h") - 1) / season) + 1)
    return shape_forecast(
        future_rows(s, horizon, step), keys, yhat, yhat + F.col("_q")[0] * wide, yhat + F.col("_q")[1] * wide
    )


def fit_quantile(df: DataFrame, probs: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Empirical quantiles per series, hour and day of week, for intermittent series."""
    calendar = time_features(F.col("ts"))
    rows = df.select("series_id", calendar["hour"].alias("hour"), calendar["dow"].alias("dow"), "value")
    q = bounded_quantiles(F.col("value"), probs)
    return rows.groupBy("series_id", "hour", "dow").agg(q.alias("q"), F.count("value").alias("n"))


def forecast_quantile(df: DataFrame, horizon: int, step: Step, *, level: float = 0.8) -> DataFrame:
    """Median and interval of the history at the same hour and day of week."""
    lo, hi = level_probs(level)
    table = fit_quantile(df, [lo, 0.5, hi]).drop("n")
    last = df.groupBy("series_id").agg(F.max("ts").alias("origin_ts"))
    calendar = time_features(F.col("ts"))
    rows = future_rows(last, horizon, step).withColumns({"hour": calendar["hour"], "dow": calendar["dow"]})
    joined = rows.join(table, ["series_id", "hour", "dow"], "left")
    return shape_forecast(joined, ["series_id"], F.col("q")[1], F.col("q")[0], F.col("q")[2])


def fit_status(df: DataFrame, min_points: int, *, whole: bool = False, positive: bool = False) -> DataFrame:
    """Per series: points known, and whether a model that needs ``min_points`` can be fitted.

    ``whole``: the model takes no NULL; ``positive``: nor a value of zero or less.
    """
    n, rows = F.count("value"), F.count(F.lit(1))
    status = F.when((rows if whole else n) < min_points, "too_short")
    if whole:
        status = status.when(n < rows, "has_gaps")
    if positive:
        status = status.when(F.min("value") <= 0, "not_positive")
    return df.groupBy("series_id").agg(n.alias("n"), status.otherwise("ok").alias("status"))
