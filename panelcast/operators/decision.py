"""From forecasts to decisions: profiles, uncertainty, events, flexibility, portfolio, ranking.

Inputs are forecast tables in the common format (``asset_id, timestamp, yhat,
lower, upper, ...``) unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.functions.calendar import time_features
from panelcast.functions.numeric import normal_cdf, normal_quantile
from panelcast.plans.grid import DAY, Step, grid_index, grid_time
from panelcast.plans.quantiles import bounded_quantiles
from panelcast.plans.tiles import lag_steps, over_tiles, runs

ASSET = ("asset_id",)


def with_ramps(forecast: DataFrame, step: Step) -> DataFrame:
    y = F.col("yhat")
    return over_tiles(
        forecast, lambda w: {"ramp": y - lag_steps("yhat", 1, w)}, step=step, back=1, keys=ASSET, ts="timestamp"
    )


def forecast_profile(forecast: DataFrame, step: Step) -> DataFrame:
    """Per asset and day: energy, peak, trough, largest ramp and when; earliest time on ties."""
    rows = with_ramps(forecast, step)
    y, t = F.col("yhat"), F.col("timestamp")
    earlier = -F.unix_micros(t.cast("timestamp"))
    steepest = F.max_by(t, F.struct(F.abs("ramp"), earlier))
    return rows.groupBy("asset_id", F.to_date("timestamp").alias("date")).agg(
        F.sum(y).alias("energy"),
        F.max(y).alias("peak"),
        F.max_by(t, F.struct(y, earlier)).alias("peak_ts"),
        F.min(y).alias("trough"),
        F.max(F.abs("ramp")).alias("max_ramp"),
        steepest.alias("max_ramp_ts"),
    )


def uncertainty(forecast: DataFrame) -> DataFrame:
    """Interval width, width relative to the forecast, and the conservative volume."""
    width = F.col("upper") - F.col("lower")
    return forecast.select(
        "asset_id",
        "timestamp",
        "yhat",
        width.alias("uncertainty"),
        F.try_divide(width, F.abs("yhat")).alias("relative_uncertainty"),
        F.col("lower").alias("conservative"),
    )


def scenarios(forecast: DataFrame, residuals: DataFrame, step: int, *, n: int | None = None) -> DataFrame:
    """Plausible futures: the forecast plus the residuals of one past day, the same day for all assets.

    ``residuals`` has ``series_id, ts, resid``.  ``scenario_id`` is the age of
    the residual day in days; ``n`` keeps the newest ones.  Every asset takes
    part in every day's scenario, so that one day for all keeps their
    correlation; ``value`` is NULL where the asset has no residual for the step
    (``event_probability`` counts those that are known).  The output is
    forecast rows times days, as asked for.
    """
    per_day = DAY // int(step)

    def place(ts: Column) -> Column:
        return F.pmod(grid_index(ts, step), F.lit(per_day))

    known = residuals.where(F.col("resid").isNotNull())
    days = known.groupBy(F.col("series_id").alias("asset_id"), F.to_date("ts").alias("_day")).agg(
        F.collect_list(F.struct(place(F.col("ts")).alias("k"), F.col("resid").alias("r"))).alias("_r")
    )
    days = days.withColumn("_r", F.map_from_entries("_r"))
    # One row: the days of the calendar that any asset has a residual for.
    calendar = known.select(F.to_date("ts").alias("_day")).distinct().agg(F.collect_list("_day").alias("_days"))
    made = forecast.groupBy("asset_id").agg(F.max("forecast_ts").alias("_made"))
    each = made.crossJoin(F.broadcast(calendar)).withColumn("_day", F.explode("_days")).drop("_days")
    age = F.datediff(F.to_date("_made"), "_day")
    aged = each.join(days, ["asset_id", "_day"], "left").withColumn("scenario_id", age)
    if n is not None:
        newest = aged.select("scenario_id").distinct().orderBy("scenario_id").limit(n)
        aged = aged.join(F.broadcast(newest), "scenario_id")
    return (
        forecast.select("asset_id", "timestamp", "yhat")
        .join(aged.select("asset_id", "scenario_id", "_r"), "asset_id")
        .select(
            "asset_id",
            "timestamp",
            "scenario_id",
            (F.col("yhat") + F.col("_r")[place(F.col("timestamp"))]).alias("value"),
        )
    )


def event_probability(paths: DataFrame, threshold: float, side: str = "above") -> DataFrame:
    """Share of scenarios above (or below) a threshold per asset and time."""
    hit = F.col("value") > threshold if side == "above" else F.col("value") < threshold
    return paths.groupBy("asset_id", "timestamp").agg(
        F.count("value").alias("n_scenarios"), F.avg(hit.cast("double")).alias("probability")
    )


def event_probability_normal(
    forecast: DataFrame, threshold: float, side: str = "above", *, level: float = 0.8
) -> DataFrame:
    """The same under a normal distribution whose interval of this level is [lower, upper]."""
    z = normal_quantile(F.lit((1 + level) / 2))
    sd = (F.col("upper") - F.col("lower")) / (2 * z)
    below = normal_cdf(F.try_divide(F.lit(threshold) - F.col("yhat"), sd))
    p = 1 - below if side == "above" else below
    return forecast.select("asset_id", "timestamp", p.alias("probability"))


def expected_events(forecast: DataFrame, step: Step, *, on: float, min_run: int = 1) -> DataFrame:
    """Operating intervals: runs of at least ``min_run`` steps with a forecast above ``on``.

    ``start_ts`` and ``stop_ts`` bound the run; ``peak_ts`` is its (first) maximum.
    """
    flag = F.coalesce(F.col("yhat") > on, F.lit(False))
    rows = runs(forecast, flag, step=step, keys=ASSET, ts="timestamp").where(flag)
    t, y = F.col("timestamp"), F.col("yhat")
    earlier = -F.unix_micros(t.cast("timestamp"))
    return (
        rows.groupBy("asset_id", "run")
        .agg(
            F.min(t).alias("start_ts"),
            grid_time(grid_index(F.max(t), step) + 1, step).alias("stop_ts"),
            F.count(F.lit(1)).alias("n_steps"),
            F.max(y).alias("peak"),
            F.max_by(t, F.struct(y, earlier)).alias("peak_ts"),
            F.sum(y).alias("energy"),
        )
        .where(F.col("n_steps") >= min_run)
        .drop("run")
    )


def regime_changes(forecast: DataFrame, step: Step, thresholds: Sequence[float]) -> DataFrame:
    """Steps where the forecast moves into another band of the given thresholds."""
    band = F.lit(0)
    for x in thresholds:
        band = band + F.when(F.col("yhat") > x, 1).otherwise(0)
    rows = over_tiles(
        forecast.withColumn("regime", band),
        lambda w: {"previous": F.lag("regime").over(w)},
        step=step,
        back=1,
        keys=ASSET,
        ts="timestamp",
    )
    return rows.where(F.col("previous") != F.col("regime")).select("asset_id", "timestamp", "previous", "regime")


def baseline_response(events: DataFrame, metering: DataFrame, forecast: DataFrame, step: Step) -> DataFrame:
    """Baseline minus observed per event window ``event_id, asset_id, start_ts, end_ts`` (end excluded).

    A window unfolds into its grid steps, so metering and forecast join on
    equal keys; no range join is needed.  Every event has a row.  ``n_missing``
    counts its steps without reading or forecast; the sums are over the others
    (NULL if there are none).
    """
    first = grid_index(F.col("start_ts"), step)
    last = grid_index(F.col("end_ts"), step) - 1
    inside = F.when(first <= last, F.sequence(first, last))
    steps = events.select("event_id", "asset_id", "start_ts", "end_ts", F.explode_outer(inside).alias("_i"))
    steps = steps.withColumn("timestamp", grid_time(F.col("_i"), step))
    observed = metering.select(F.col("series_id").alias("asset_id"), F.col("ts").alias("timestamp"), "value")
    joined = steps.join(observed, ["asset_id", "timestamp"], "left").join(
        forecast.select("asset_id", "timestamp", "yhat"), ["asset_id", "timestamp"], "left"
    )
    gain = F.col("yhat") - F.col("value")
    return joined.groupBy("event_id", "asset_id", "start_ts", "end_ts").agg(
        F.count("_i").alias("n_steps"),
        F.count_if(F.col("_i").isNotNull() & gain.isNull()).alias("n_missing"),
        F.sum(F.when(gain.isNotNull(), F.col("yhat"))).alias("baseline"),
        F.sum(F.when(gain.isNotNull(), F.col("value"))).alias("observed"),
        F.sum(gain).alias("response"),
    )


def portfolio_forecast(forecast: DataFrame, levels: Sequence[str] = ()) -> DataFrame:
    """Sum per time, for every level of a hierarchy (columns of the forecast, top first) and in total.

    In a total row the levels below it are NULL; ``depth`` says how many are set.
    """
    levels = list(levels)
    if not levels:
        return forecast.groupBy("timestamp").agg(F.sum("yhat").alias("yhat"), F.count("yhat").alias("n_assets"))
    partial = forecast.groupBy("timestamp", *levels).agg(F.sum("yhat").alias("_y"), F.count("yhat").alias("_n"))
    depth = sum((1 - F.grouping(c) for c in levels), F.lit(0))
    # Roll up the small partial table: each row is copied once per level.
    rolled = partial.rollup("timestamp", *levels).agg(
        F.sum("_y").alias("yhat"), F.sum("_n").alias("n_assets"), depth.cast("bigint").alias("depth")
    )
    return rolled.where(F.col("timestamp").isNotNull())


def portfolio_uncertainty(residuals: DataFrame) -> DataFrame:
    """Deviation of the summed residuals, and what it would be if assets were independent.

    The variance of the sum holds all covariances, so no pair of assets is ever
    formed.  Every time counts, with the residuals of the assets present;
    ``presence`` is the mean share of assets that are.  Below 1, both deviations
    rest on different rows, and their ratio is a rough one.
    """
    known = residuals.where(F.col("resid").isNotNull())
    per_time = known.groupBy("ts").agg(F.sum("resid").alias("_sum"), F.count_distinct("series_id").alias("_n"))
    portfolio = per_time.agg(
        F.count(F.lit(1)).alias("n_steps"), F.stddev_samp("_sum").alias("sigma_portfolio"), F.avg("_n").alias("_present")
    )
    single = known.groupBy("series_id").agg(F.var_samp("resid").alias("_v"))
    alone = single.agg(F.count(F.lit(1)).alias("n_assets"), F.sqrt(F.sum("_v")).alias("sigma_independent"))
    both = portfolio.crossJoin(F.broadcast(alone))
    return both.withColumns(
        {
            "diversification": F.try_divide("sigma_portfolio", "sigma_independent"),
            "presence": F.try_divide("_present", "n_assets"),
        }
    ).drop("_present")


def flex_envelope(
    forecast: DataFrame, history: DataFrame, step: Step, *, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """How far each asset can go down and up from its forecast.

    Capacities are history quantiles at the same hour and weekday (a group holds
    one value per past week and step), else at the same hour, else of the whole
    history; no change exceeds the largest ramp seen.  Every forecast row is
    returned, with NULL for an asset without history.
    """
    calendar = time_features(F.col("ts"))
    past = history.select("series_id", "ts", "value", calendar["hour"].alias("hour"), calendar["dow"].alias("dow"))
    past = past.withColumnRenamed("series_id", "asset_id")

    def caps(name: str, *by: str) -> DataFrame:
        return past.groupBy("asset_id", *by).agg(bounded_quantiles(F.col("value"), [low, high]).alias(name))

    v = F.col("value")
    ramps = over_tiles(history, lambda w: {"_r": F.abs(v - lag_steps("value", 1, w))}, step=step, back=1)
    limit = ramps.groupBy(F.col("series_id").alias("asset_id")).agg(F.max("_r").alias("_limit"))
    t = time_features(F.col("timestamp"))
    rows = (
        forecast.withColumns({"hour": t["hour"], "dow": t["dow"]})
        .join(caps("_q1", "hour", "dow"), ["asset_id", "hour", "dow"], "left")
        .join(caps("_q2", "hour"), ["asset_id", "hour"], "left")
        .join(caps("_q3"), "asset_id", "left")
        .join(limit, "asset_id", "left")
        .withColumn("_q", F.coalesce("_q1", "_q2", "_q3"))
    )
    y = F.col("yhat")

    def held(x: Column) -> Column:
        """NULL stays NULL: greatest and least would pass over it."""
        return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.col("_limit")))

    down, up = held(y - F.col("_q")[0]), held(F.col("_q")[1] - y)
    return rows.select("asset_id", "timestamp", "yhat", down.alias("reduction"), up.alias("increase"))


def portfolio_flexibility(envelope: DataFrame) -> DataFrame:
    """Sums over the assets; ``n_assets`` counts those whose flexibility is known."""
    return envelope.groupBy("timestamp").agg(
        F.sum("reduction").alias("reduction"), F.sum("increase").alias("increase"), F.count("reduction").alias("n_assets")
    )


def soc_envelope(forecast: DataFrame, *, capacity: float, soc0: float, target: float) -> DataFrame:
    """State of charge along the forecast, kept within 0 .. capacity, and whether it has reached ``target``.

    A clamped running sum depends on every step before, so an asset's forecast
    is folded in order; its length is the forecast horizon.
    """
    rows = F.array_sort(F.collect_list(F.struct("timestamp", "yhat")))
    paths = forecast.groupBy("asset_id").agg(rows.alias("_rows"))

    def charge(path: Column, row: Column) -> Column:
        before = F.coalesce(F.try_element_at(path, F.lit(-1))["soc"], F.lit(float(soc0)))
        now = F.least(F.greatest(before + F.coalesce(row["yhat"], F.lit(0.0)), F.lit(0.0)), F.lit(float(capacity)))
        return F.array_append(path, F.struct(row["timestamp"].alias("timestamp"), now.alias("soc")))

    empty = F.array().cast("array<struct<timestamp: timestamp_ntz, soc: double>>")
    soc = paths.select("asset_id", F.aggregate("_rows", empty, charge).alias("_p"))
    soc = soc.withColumn("first_reached_ts", F.array_min(F.transform(F.filter("_p", lambda r: r["soc"] >= target), lambda r: r["timestamp"])))
    return soc.select("asset_id", "first_reached_ts", F.inline("_p")).select(
        "asset_id", "timestamp", "soc", (F.lit(float(capacity)) - F.col("soc")).alias("headroom"), "first_reached_ts"
    )


def delivery_probability(paths: DataFrame, promised: DataFrame) -> DataFrame:
    """Share of scenarios that reach the promised ``volume`` per asset and time."""
    rows = paths.join(promised.select("asset_id", "timestamp", "volume"), ["asset_id", "timestamp"])
    return rows.groupBy("asset_id", "timestamp", "volume").agg(
        F.avg((F.col("value") >= F.col("volume")).cast("double")).alias("p_delivery")
    )


def tradable_volume(paths: DataFrame, promised: DataFrame, mode: str = "expected") -> DataFrame:
    """Volume times the probability of delivering it, or the 10 % quantile over scenarios."""
    if mode == "expected":
        p = delivery_probability(paths, promised)
        return p.withColumn("tradable", F.col("volume") * F.col("p_delivery"))
    q = paths.groupBy("asset_id", "timestamp").agg(bounded_quantiles(F.col("value"), [0.1])[0].alias("tradable"))
    return promised.select("asset_id", "timestamp", "volume").join(q, ["asset_id", "timestamp"])


def opportunity_value(volumes: DataFrame, prices: DataFrame) -> DataFrame:
    """Expected volume times expected price times the probability of delivery."""
    rows = volumes.join(prices.select("timestamp", "price"), "timestamp")
    return rows.withColumn("expected_value", F.col("volume") * F.col("price") * F.col("p_delivery"))


def rank_opportunities(values: DataFrame, k: int, *, per: str = "timestamp", by: str = "expected_value") -> DataFrame:
    """The k most valuable rows per time (or per ``date``); ties go to the lower asset, then the earlier time.

    A first cut inside (group, salt) keeps at most k candidates per salt, which
    is exact for a top k, so a large group never sits in one task.
    """
    rows = values.withColumn("_per", F.to_date("timestamp") if per == "date" else F.col("timestamp"))
    order = [F.col(by).desc_nulls_last(), F.col("asset_id"), F.col("timestamp")]
    salted = rows.withColumn("_salt", F.pmod(F.hash("asset_id", "timestamp"), F.lit(32)))
    local = Window.partitionBy("_per", "_salt").orderBy(*order)
    some = salted.withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= k)
    final = Window.partitionBy("_per").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).drop("_per", "_salt", "_r")


def robust_value(paths: DataFrame, prices: DataFrame) -> DataFrame:
    """Mean and 10 % quantile of scenario value per asset and time, to rank by either."""
    value = F.col("value") * F.col("price")
    rows = paths.join(prices.select("timestamp", "price"), "timestamp")
    return rows.groupBy("asset_id", "timestamp").agg(
        F.avg(value).alias("mean_value"), bounded_quantiles(value, [0.1])[0].alias("q10_value")
    )
