"""One model over all series, in the form of the models that are fitted per series.

Trees learn from series brought to one scale (less their mean, over their deviation), so that large series don't decide
alone.  Features of a row come from rows before it only, so one feature table serves every fold: a fold takes its rows
up to each series' end, and nothing of the panel is copied per fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelcast.operators.forecast.baseline import shape_forecast
from panelcast.operators.forecast.forest import fit_gbt, fit_random_forest, forecast_recursive
from panelcast.operators.forecast.quantile import forecast_quantile_regression
from panelcast.operators.forecast.var import forecast_var
from panelcast.operators.windows import feature_matrix
from panelcast.plans.grid import DAY, Step
from panelcast.plans.tiles import join_series
from panelcast.session import shared_dir

MODELS = ("var", "forest", "gbt", "quantile")
#: Series of a vector autoregression at most: its coefficients grow with their square.
VAR_SERIES = 12
FOREST = {"n_trees": 20, "max_depth": 6}
GBT = {"n_trees": 20, "max_depth": 4}


def lag_set(step: Step) -> tuple[list[int], list[int]]:
    """(lags, windows): the last three steps and a cycle back, which is a day, or a week of days."""
    if step == "month":
        raise ValueError("tree models need a step of fixed length: their features are hour and weekday")
    cycle = DAY // int(step) if int(step) < DAY else 7
    return sorted({1, 2, 3, max(cycle, 1)}), [max(cycle, 2)]


def pooled_features(df: DataFrame, step: Step) -> DataFrame:
    """:func:`feature_matrix` with :func:`lag_set`, written: every fold and model reads this table."""
    lags, windows = lag_set(step)
    made = feature_matrix(df.select("series_id", "ts", "value"), step, lags=lags, windows=windows)
    path = shared_dir(df.sparkSession, "features")
    made.write.parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def forecast_pooled(df: DataFrame, horizon: int, step: Step, *, model: str, features: DataFrame | None = None, level: float = 0.8) -> DataFrame:
    """``var``, ``forest``, ``gbt`` or ``quantile`` beyond the end of every series of a regular panel.

    ``features`` may reach further than ``df``: only rows up to a series' last one in ``df`` are learnt from.  A series
    too short for the features (or with a gap in its newest rows) has no forecast; no series has one if there is nothing
    to learn from.  The forest's interval is the spread of its trees; boosted trees have none (NULL).
    """
    known = df.select("series_id", "ts", "value")
    if model == "quantile":
        return forecast_quantile_regression(known, horizon, step, level=level)
    if model == "var":
        # One more than allowed, at most.
        names = sorted(r[0] for r in known.select("series_id").distinct().limit(VAR_SERIES + 1).collect())
        if len(names) > VAR_SERIES:
            raise ValueError(f"a vector autoregression takes {VAR_SERIES} series at most; choose some")
        return forecast_var(known, names, horizon, step, level=level)
    if model not in MODELS:
        raise ValueError(f"unknown pooled model {model!r}; known: {', '.join(MODELS)}")
    lags, windows = lag_set(step)
    features = pooled_features(known, step) if features is None else features
    scale = F.coalesce(F.nullif(F.stddev_pop("value"), F.lit(0.0)), F.lit(1.0))
    units = known.groupBy("series_id").agg(F.max("ts").alias("_end"), F.avg("value").alias("_mean"), scale.alias("_scale"))
    unit = lambda c: ((F.col(c) - F.col("_mean")) / F.col("_scale")).alias(c)
    values = [*(f"lag_{k}" for k in lags), *(f"rmean_{k}" for k in windows)]
    rows = join_series(features, units).where(F.col("ts") <= F.col("_end"))
    rows = rows.select("series_id", "ts", *[unit(c) for c in values], "hour", "dow", unit("y"))
    scaled = join_series(known, units).select("series_id", "ts", unit("value"))
    if rows.dropna().isEmpty():
        none = F.lit(None).cast("double")
        empty = known.limit(0).select("series_id", F.lit(0).cast("bigint").alias("h"), "ts", F.col("ts").alias("origin_ts"))
        return shape_forecast(empty, ["series_id"], none, none, none)
    fitted = fit_random_forest(rows, **FOREST) if model == "forest" else fit_gbt(rows, **GBT)
    ahead = join_series(forecast_recursive(scaled, fitted, horizon, step, lags=lags, windows=windows, level=level), units)
    back = lambda c: F.col(c) * F.col("_scale") + F.col("_mean")
    return shape_forecast(ahead, ["series_id"], back("yhat"), back("lower"), back("upper"))


def fold_forecasts(df: DataFrame, split: DataFrame, horizon: int, step: Step, *, folds: int, models: Sequence[str]) -> DataFrame:
    """:func:`forecast_pooled` of every model behind the train part of each fold (``split`` marks them), with ``fold, model``."""
    features = pooled_features(df, step) if {"forest", "gbt"} & set(models) else None
    parts = []
    for k in range(1, folds + 1):
        train = split.where((F.col("fold") == k) & (F.col("part") == "train"))
        for m in models:
            made = forecast_pooled(train, horizon, step, model=m, features=features)
            parts.append(made.withColumns({"fold": F.lit(k).cast("bigint"), "model": F.lit(m)}))
    return reduce(DataFrame.unionByName, parts)
