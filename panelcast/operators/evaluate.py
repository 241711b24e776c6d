"""Accuracy metrics, back-testing and model choice."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelcast.functions.calendar import time_features
from panelcast.operators.clean import ffill_bfill, split_last
from panelcast.operators.forecast.arima import FLAT, Order, Seasonal, Terms, forecast_sarima
from panelcast.operators.forecast.baseline import fit_status, forecast_mean, forecast_naive, forecast_snaive
from panelcast.operators.forecast.carried import carried_forecasts, fold_origins, rolling_origins
from panelcast.operators.forecast import pooled
from panelcast.operators.forecast.smoothing import forecast_smoothing, points_needed, rolling_smoothing, smoothing_grid_scores
from panelcast.operators.forecast.structural import forecast_structural
from panelcast.operators.windows import prefix_stats
from panelcast.plans.grid import Step, grid_index, grid_time
from panelcast.plans.quantiles import exact_quantiles
from panelcast.plans.tiles import attach, join_series, over_tiles, positions, regular_positions, time_tile
from panelcast.schema import select_eval
from panelcast.session import shared_dir
from panelcast.sources.files import load_model, save_model

Forecaster = Callable[..., DataFrame]


def error_columns() -> list[Column]:
    """Aggregates over ``actual`` and ``forecast``; a zero actual is left out of MAPE and counted.

    ``n`` counts the rows that are compared, ``n_missing`` actual values without a forecast.
    """
    e = F.col("actual") - F.col("forecast")
    rel = F.abs(F.try_divide(e, F.col("actual")))
    return [
        F.count(e).alias("n"),
        F.count_if(F.col("actual").isNotNull() & F.col("forecast").isNull()).alias("n_missing"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(rel) * 100).alias("mape"),
        F.count(rel).alias("n_mape"),
    ]


def metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*error_columns())


def metrics_filled(actual: DataFrame, forecast: DataFrame, step: Step) -> DataFrame:
    """Metrics per series after filling gaps on both sides; unequal times are an error."""
    a = ffill_bfill(actual.select("series_id", "ts", "value"), step).withColumnRenamed("value", "actual")
    f = ffill_bfill(forecast.select("series_id", "ts", "value"), step).withColumnRenamed("value", "forecast")
    a, f = a.withColumn("_a", F.lit(True)), f.withColumn("_f", F.lit(True))
    both = a.join(f, ["series_id", "ts"], "full")
    odd = F.col("_a").isNull() | F.col("_f").isNull()
    message = F.concat_ws(" ", F.lit("one side only:"), "series_id", F.col("ts").cast("string"))
    checked = F.when(odd, F.raise_error(message).cast("double")).otherwise(F.col("actual"))
    return metrics(both.withColumn("actual", checked), ["series_id"])


def expanding_folds(
    df: DataFrame, n_splits: int = 5, *, test_size: int | None = None, step: Step | None = None
) -> DataFrame:
    """Rows marked ``train`` or ``test`` for each fold; a row appears at most ``n_splits`` times.

    The test parts are the last ``n_splits`` blocks of n // (n_splits + 1) rows
    (or of ``test_size``); everything before a block trains it.  Give ``step``
    for a regular panel, which needs no counting.
    """
    size = F.floor(F.col("n") / (n_splits + 1)) if test_size is None else F.lit(test_size)
    numbered = positions(df) if step is None else regular_positions(df, step)
    rows = numbered.withColumn("_size", size.cast("bigint"))
    rows = rows.withColumn("fold", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(n_splits).cast("bigint"))))
    start = F.col("n") - (n_splits - F.col("fold") + 1) * F.col("_size")
    at = F.col("pos") - 1
    part = F.when((at >= start) & (at < start + F.col("_size")), "test").when(at < start, "train")
    return rows.withColumn("part", part).where(F.col("part").isNotNull() & (start > 0)).drop("pos", "n", "_size")


def steps_ahead(folds: DataFrame, keys: Sequence[str], step: Step) -> int:
    """Grid steps from a train part's end to its test part's, the most over all folds: one number, aggregated."""
    i = grid_index(F.col("ts"), step)
    ends = folds.groupBy(*keys).agg(*[F.max(F.when(F.col("part") == p, i)).alias(p) for p in ("train", "test")])
    return max(1, ends.agg(F.max(F.col("test") - F.col("train"))).first()[0] or 1)


def evaluate_folds(
    folds: DataFrame,
    forecaster: Forecaster,
    horizon: int | None,
    step: Step,
    *,
    model: str,
    keys: Sequence[str] = ("series_id", "fold"),
    **kw,
) -> DataFrame:
    """Forecast every fold's test rows from its train rows; folds are extra keys, not a loop.

    Every test row is returned.  One without a forecast (beyond ``horizon``, or of a series the model can't be fitted
    to) has NULL in ``forecast``.  ``horizon`` None reaches the end of the longest test part.
    """
    keys = list(keys)
    train = folds.where("part = 'train'").select(*keys, "ts", "value")
    steps = steps_ahead(folds, keys, step) if horizon is None else horizon
    made = forecaster(train, steps, step, keys=keys, **kw).withColumn("model", F.lit(model))
    return _score_folds(folds, made, keys, [model])


def _score_folds(folds: DataFrame, made: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """Each test row once for each model, with its forecast if there is one."""
    each = F.explode(F.array(*[F.lit(m) for m in models]))
    test = folds.where("part = 'test'").select(*keys, "ts", F.col("value").alias("actual"), each.alias("model"))
    guess = made.select(*keys, "ts", F.col("h").alias("horizon"), F.col("yhat").alias("forecast"), "origin_ts", "model")
    return test.join(guess, [*keys, "ts", "model"], "left").withColumn("error", F.col("actual") - F.col("forecast"))


def expanding_autoregression(
    df: DataFrame, step: Step, n_splits: int = 5, *, test_size: int | None = None, order: Order = (1, 0, 0), seasonal: Seasonal = FLAT
) -> DataFrame:
    """``evaluate_folds`` of ``expanding_folds`` for an autoregression, without copying history: see ``forecast.carried``.

    Every test row is returned, with ``n_train``; one whose fold is too short to fit, or has a gap, has no forecast.
    """
    # One number: the longest test part.
    longest = test_size or df.groupBy("series_id").count().agg(F.max(F.floor(F.col("count") / (n_splits + 1)))).first()[0] or 1
    rows = carried_forecasts(df, step, fold_origins(n_splits, test_size), max(int(longest), 1), order=order, seasonal=seasonal)
    # Test parts are as long as their series allow.
    sizes = df.groupBy("series_id").agg((F.floor(F.count(F.lit(1)) / (n_splits + 1)) if test_size is None else F.lit(test_size)).alias("_size"))
    rows = join_series(rows, sizes).where(F.col("horizon") <= F.col("_size")).drop("_size")
    return rows.withColumns({"model": F.lit("sarima" if any(seasonal) else "arima"), "error": F.col("actual") - F.col("forecast")})


def fold_status(df: DataFrame, n_splits: int = 5, *, test_size: int | None = None, least: int = 1) -> DataFrame:
    """Per series and fold of ``expanding_folds``: ``n_train``, ``n_test`` and ``ok`` or ``too_short``.

    A fold without rows to test, or with fewer than ``least`` to train on, is too short; ``expanding_folds`` has no rows
    for those without any.
    """
    n = F.count(F.lit(1))
    sizes = df.groupBy("series_id").agg(n.alias("_n"), (F.floor(n / (n_splits + 1)) if test_size is None else F.lit(test_size)).alias("_size"))
    rows = sizes.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    train = F.greatest(F.col("_n") - (n_splits - F.col("fold") + 1) * F.col("_size"), F.lit(0)).cast("bigint")
    rows = rows.select("series_id", F.col("fold").cast("bigint").alias("fold"), train.alias("n_train"), F.col("_size").cast("bigint").alias("n_test"))
    short = (F.col("n_train") < least) | (F.col("n_test") < 1)
    return rows.withColumn("status", F.when(short, "too_short").otherwise("ok"))


def rolling_origin(
    df: DataFrame,
    model: str,
    step: Step,
    *,
    train_size: int = 60,
    max_horizon: int = 6,
    season: int = 12,
    order: Order = (1, 0, 0),
    seasonal: Seasonal = FLAT,
) -> DataFrame:
    """Forecasts from every origin with at least ``train_size`` points, 1 .. ``max_horizon`` steps on.

    The forecast for h steps is compared with the value h steps after the last
    training point.  Baselines read forecast and actual from one tiled window,
    smoothing models carry their state through one pass, so no training set is
    copied per origin.  Models: mean, naive, snaive, ses, holt, add, mul, and arima
    and sarima without moving-average terms (``order``, ``seasonal``), which are
    fitted at each origin from normal equations carried along the series.
    """
    if model in ("arima", "sarima"):
        seasonal = seasonal if model == "sarima" else FLAT
        rows = carried_forecasts(df, step, rolling_origins(train_size, max_horizon), max_horizon, order=order, seasonal=seasonal)
        return select_eval(rows.withColumns({"model": F.lit(model), "error": F.col("actual") - F.col("forecast")}))
    if model in ("ses", "holt", "add", "mul"):
        return rolling_smoothing(df, model, train_size=train_size, max_horizon=max_horizon, period=season)
    if model not in ("mean", "naive", "snaive"):
        raise ValueError(f"unknown model {model!r}")
    if model == "snaive" and train_size < season:
        raise ValueError("the training part must hold one season")
    v = F.col("value")
    rows = prefix_stats(df, step).drop("prefix_var") if model == "mean" else df
    hs = range(1, max_horizon + 1)

    def guess(w: WindowSpec, h: int) -> Column:
        if model == "mean":
            return F.lead("prefix_mean", 1).over(w)
        if model == "naive":
            return v
        back = season - 1 - (h - 1) % season
        return F.lag(v, back).over(w) if back else v

    def columns(w: WindowSpec) -> dict[str, Column]:
        steps = [
            F.struct(
                F.lit(h).cast("bigint").alias("horizon"),
                F.lead(v, h).over(w).alias("actual"),
                guess(w, h).alias("forecast"),
            )
            for h in hs
        ]
        return {
            "_steps": F.array(*steps),
            "_trained": F.lag(F.lit(1), train_size - 1).over(w),
            "_ends": F.lead(F.lit(1), max_horizon).over(w),
        }

    back = max(train_size, season if model == "snaive" else 0)
    wide = over_tiles(rows, columns, step=step, back=back, ahead=max_horizon)
    usable = wide.where(F.col("_trained").isNotNull() & F.col("_ends").isNotNull())
    long = usable.select("series_id", F.col("ts").alias("origin_ts"), F.inline("_steps"))
    target = grid_time(grid_index(F.col("origin_ts"), step) + F.col("horizon"), step)
    return select_eval(
        long.withColumns(
            {"model": F.lit(model), "ts": target, "error": F.col("actual") - F.col("forecast")}
        )
    )


def metrics_by_horizon(evaluation: DataFrame) -> DataFrame:
    e = F.col("error")
    return evaluation.groupBy("horizon").agg(
        F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")
    )


def yearly_cutoffs(df: DataFrame, *, skip_years: int = 2, leave_years: int = 1) -> DataFrame:
    """Month-end cutoffs every 12 months, from first + 2 years to last - 1 year of each series."""
    span = df.groupBy("series_id").agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi"))
    lo = F.last_day(F.add_months("_lo", 12 * skip_years))
    hi = F.add_months("_hi", -12 * leave_years)
    starts = F.sequence(F.date_trunc("month", lo).cast("date"), hi, F.expr("INTERVAL 12 MONTHS"))
    cut = span.where(lo <= hi).select("series_id", F.explode(starts).alias("_m"), hi.alias("_hi"))
    return (
        cut.withColumn("cutoff", F.last_day("_m"))
        .where(F.col("cutoff") <= F.col("_hi"))
        .select("series_id", F.col("cutoff").cast("timestamp_ntz").alias("cutoff"))
    )


def cutoff_cv(
    df: DataFrame,
    forecaster: Forecaster,
    horizon: int | None,
    step: Step,
    *,
    horizon_days: int = 365,
    model: str = "model",
    **kw,
) -> DataFrame:
    """Evaluation rows for every yearly cutoff: train up to it, test the days after it (see ``evaluate_folds``)."""
    folds = cutoff_folds(df, horizon_days)
    return evaluate_folds(folds, forecaster, horizon, step, model=model, keys=["series_id", "cutoff"], **kw)


def cutoff_folds(df: DataFrame, horizon_days: int = 365) -> DataFrame:
    """Rows marked ``train`` or ``test`` for each yearly cutoff of their series."""
    rows = df.join(yearly_cutoffs(df), "series_id")
    end = F.col("cutoff") + F.expr(f"INTERVAL {int(horizon_days)} DAYS")
    part = F.when(F.col("ts") <= F.col("cutoff"), "train").when(F.col("ts") <= end, "test")
    return rows.withColumn("part", part).where(F.col("part").isNotNull())


# The parameter sets that are tried.
STRUCTURAL_GRID = ({"changepoint_prior": 0.1, "season_prior": 1.0}, {"changepoint_prior": 0.5, "season_prior": 1.0})


def grid_search_structural(
    df: DataFrame, step: Step, grid: Sequence[dict] = STRUCTURAL_GRID, *, horizon_days: int = 365, **kw
) -> tuple[DataFrame, DataFrame]:
    """(best parameter set per series, all scores) by mean squared error over the yearly cutoffs; the first wins ties.

    A series without a cutoff has no row in either.
    """
    folds, keys = cutoff_folds(df, horizon_days), ["series_id", "cutoff"]
    steps = steps_ahead(folds, keys, step)
    parts = []
    for i, params in enumerate(grid):
        rows = evaluate_folds(folds, forecast_structural, steps, step, model="structural", keys=keys, **params, **kw)
        known = {k: F.lit(float(x)) for k, x in params.items()}
        parts.append(metrics(rows, ["series_id"]).withColumn("trial", F.lit(i).cast("bigint")).withColumns(known))
    scores = reduce(DataFrame.unionByName, parts).select("series_id", "trial", *grid[0], "n", "n_missing", "mse")
    best = scores.groupBy("series_id").agg(F.min(F.struct("n_missing", "mse", "trial")).alias("_b"))
    return best.select("series_id", "_b.trial"), scores


def forecast_tuned_structural(
    df: DataFrame, horizon: int, step: Step, grid: Sequence[dict] = STRUCTURAL_GRID, *, horizon_days: int = 365, **kw
) -> DataFrame:
    """Fit every series again on all of its rows with its best parameter set; the first set if it has no cutoff."""
    best, _ = grid_search_structural(df, step, grid, horizon_days=horizon_days, **kw)
    # One row per series, read by every branch below: written, so the search runs once.
    path = shared_dir(df.sparkSession, "tuned")
    save_model(best, path)
    best = load_model(df.sparkSession, path)
    rows = df.join(best, "series_id", "left").withColumn("trial", F.coalesce("trial", F.lit(0)))
    parts = [
        forecast_structural(rows.where(F.col("trial") == i).drop("trial"), horizon, step, **params, **kw).withColumn("trial", F.lit(i))
        for i, params in enumerate(grid)
    ]
    return reduce(DataFrame.unionByName, parts)


def grid_search_smoothing(
    df: DataFrame, kind: str, *, n_test: int, period: int = 12
) -> tuple[DataFrame, DataFrame]:
    """(best parameters per series, all scores); parameter rows in grid order, the first wins ties."""
    parts = split_last(df, n_test)
    train, check = (parts.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    scores = smoothing_grid_scores(train, check, kind, period=period)
    order = F.struct("rmse", "alpha", "beta", "gamma")
    best = scores.groupBy("series_id").agg(F.min(order).alias("_b")).select("series_id", "_b.*")
    return best, scores


def attach_forecast(test: DataFrame, forecast: DataFrame) -> DataFrame:
    """Left join: a test row without a forecast keeps NULLs."""
    f = forecast.select(F.col("asset_id").alias("series_id"), F.col("timestamp").alias("ts"), "yhat", "lower", "upper")
    return test.join(f, ["series_id", "ts"], "left")


MODELS: dict[str, tuple[Forecaster, dict]] = {
    "mean": (forecast_mean, {}),
    "naive": (forecast_naive, {}),
    "snaive": (forecast_snaive, {"season": 12}),
    "ses": (forecast_smoothing, {"kind": "ses"}),
    "holt": (forecast_smoothing, {"kind": "holt"}),
    "hw_add": (forecast_smoothing, {"kind": "add", "period": 12}),
    "hw_mul": (forecast_smoothing, {"kind": "mul", "period": 12}),
    "arima": (forecast_sarima, {"order": (1, 1, 1)}),
    "sarima": (forecast_sarima, {"order": (1, 0, 1), "seasonal": (1, 1, 1, 12)}),
    "structural": (forecast_structural, {}),
}


def run_model(train: DataFrame, horizon: int, step: Step, *, model: str, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """A model of the registry, or of ``pooled.MODELS`` (one model over all series, without further keys), by name."""
    if model in pooled.MODELS and list(keys) == ["series_id"]:
        return pooled.forecast_pooled(train, horizon, step, model=model)
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r} for keys {list(keys)}; known: {', '.join([*MODELS, *pooled.MODELS])}")
    forecaster, options = MODELS[model]
    options = dict(options)
    if "kind" in options:
        return forecaster(train, options.pop("kind"), horizon, step, keys=keys, **options)
    return forecaster(train, horizon, step, keys=keys, **options)


def compare_models(
    df: DataFrame, step: Step, *, folds: int = 3, horizon: int = 12, models: Sequence[str] = tuple(MODELS)
) -> DataFrame:
    """Evaluation rows of every model on the last ``folds`` blocks of ``horizon`` points; NULL where a model has no forecast.

    ``models`` may name those of ``pooled.MODELS`` as well, which are trained once per fold over all series.
    """
    split = expanding_folds(df, folds, test_size=horizon, step=step)
    keys = ["series_id", "fold"]
    train = split.where("part = 'train'").select(*keys, "ts", "value")
    made = [run_model(train, horizon, step, model=m, keys=keys).withColumn("model", F.lit(m)) for m in models if m not in pooled.MODELS]
    if together := [m for m in models if m in pooled.MODELS]:
        made.append(pooled.fold_forecasts(df, split, horizon, step, folds=folds, models=together))
    return _score_folds(split, reduce(DataFrame.unionByName, made), keys, models)


def leaderboard(evaluation: DataFrame, by: str = "mae") -> DataFrame:
    """Mean of the fold metrics per model, ranked.

    All models are compared on the same rows, those that every model has a forecast for; ``n_missing`` counts the
    actual values a model has none for, ``n_fits`` the folds that count.
    """
    test = Window.partitionBy("series_id", "fold", "ts")
    shared = F.count("forecast").over(test) == F.count(F.lit(1)).over(test)
    rows = evaluation.withColumn("_shared", shared)
    per_fold = rows.groupBy("series_id", "model", "fold").agg(
        F.count_if("_shared").alias("_rows"),
        F.count_if(F.col("actual").isNotNull() & F.col("forecast").isNull()).alias("_missing"),
        *_shared_errors(),
    )
    names = ["mse", "mae", "rmse", "mape"]
    table = per_fold.groupBy("model").agg(
        F.count_if(F.col("_rows") > 0).alias("n_fits"), F.sum("_missing").alias("n_missing"), *[F.avg(m).alias(m) for m in names]
    )
    return table.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last(by), "model")))


def _shared_errors() -> list[Column]:
    e = F.when(F.col("_shared"), F.col("actual") - F.col("forecast"))
    return [
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(e, F.col("actual")))) * 100).alias("mape"),
    ]


def best_model_per_series(evaluation: DataFrame, by: str = "mae") -> DataFrame:
    """The model with the least error; one that lacks forecasts comes after those that lack fewer.

    Every series has a row; ``model`` is NULL for one that no model has a comparable forecast for.
    """
    scores = metrics(evaluation, ["series_id", "model"])
    rank = F.when(F.col(by).isNotNull(), F.struct("n_missing", by, "model"))
    return scores.groupBy("series_id").agg(F.min(rank).alias("_b")).select("series_id", "_b.model", f"_b.{by}")


def forecast_status(df: DataFrame, models: Sequence[str] = tuple(MODELS)) -> DataFrame:
    """Per series and model of the registry: ``ok``, ``too_short``, ``has_gaps`` or ``not_positive``, and the rows seen."""
    parts = []
    for m in models:
        forecaster, options = MODELS[m]
        if forecaster is forecast_smoothing:
            kind = options["kind"]
            status = fit_status(df, points_needed(kind, options.get("period", 1)), whole=True, positive=kind == "mul")
        elif forecaster is forecast_sarima:
            status = fit_status(df, Terms.of(**options).points_needed, whole=True)
        else:
            status = fit_status(df, 1)
        parts.append(status.withColumn("model", F.lit(m)))
    return reduce(DataFrame.unionByName, parts)


def bias_and_coverage(df: DataFrame, by: Sequence[str] = ("series_id",)) -> DataFrame:
    """Bias = mean of forecast minus actual; coverage = share of actuals inside the interval.

    Reads ``value``, ``yhat``, ``lower``, ``upper`` (see ``attach_forecast``).
    """
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    return df.groupBy(*by).agg(
        F.count("yhat").alias("n"),
        F.avg(F.col("yhat") - F.col("value")).alias("bias"),
        F.avg(inside.cast("double")).alias("coverage"),
    )


def error_by_segment(evaluation: DataFrame, segment: str) -> DataFrame:
    """Metrics per calendar segment: settlement_period, hour, dow, month or is_weekend."""
    calendar = time_features(F.col("ts"))
    return metrics(evaluation.withColumn("segment", calendar[segment]), ["segment"])


def error_by_load(evaluation: DataFrame, regimes: int = 4) -> DataFrame:
    """Metrics per load regime: quantile bands of the actual value within each series."""
    probs = [i / regimes for i in range(1, regimes)]
    cuts = exact_quantiles(evaluation, probs, value="actual").select("series_id", "q")
    rows = attach(time_tile(evaluation), cuts)
    regime = F.lit(1)
    for j in range(len(probs)):
        regime = regime + F.when(F.col("actual") > F.col("q")[j], 1).otherwise(0)
    return metrics(rows.withColumn("regime", regime), ["regime"])


def rmse_per_series(evaluation: DataFrame) -> DataFrame:
    e = F.col("actual") - F.col("forecast")
    return evaluation.groupBy("series_id").agg(F.sqrt(F.avg(e * e)).alias("rmse"))


def holdout_predict(df: DataFrame, model: str, step: Step, *, n_test: int = 12) -> DataFrame:
    """Evaluation rows of one model on the last ``n_test`` points."""
    folds = expanding_folds(df, 1, test_size=n_test, step=step)
    return evaluate_folds(folds, lambda t, h, s, *, keys: run_model(t, h, s, model=model, keys=keys), n_test, step, model=model)


def future_predict(df: DataFrame, model: str, step: Step, *, horizon: int = 24) -> DataFrame:
    """Fit on everything and forecast beyond the end."""
    return run_model(df, horizon, step, model=model)

