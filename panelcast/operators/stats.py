"""Autocorrelation, decomposition, stationarity and residual diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelcast.functions.numeric import normal_cdf, normal_quantile
from panelcast.operators.ols import best_nested, solved, vector_sums
from panelcast.plans.grid import Step, grid_index
from panelcast.plans.quantiles import exact_quantiles, ranked_values
from panelcast.plans.tiles import attach, join_series, merge_tables, over_tiles, row_tile, time_tile


def series_moments(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per series: ``_n``, ``_mean``, ``_pop`` and ``_samp`` deviation; partial aggregates."""
    return df.groupBy("series_id").agg(
        F.count(value).alias("_n"),
        F.avg(value).alias("_mean"),
        F.stddev_pop(value).alias("_pop"),
        F.stddev_samp(value).alias("_samp"),
    )


def zscore(df: DataFrame) -> DataFrame:
    """Add ``zscore``: distance from the series mean in population deviations; constant series NULL."""
    t = time_tile(df)
    score = F.try_divide(F.col("value") - F.col("_mean"), F.col("_pop"))
    return attach(t, series_moments(df)).select(*df.columns, score.alias("zscore"))


def acf(df: DataFrame, nlags: int, step: Step) -> DataFrame:
    """Autocorrelations r_1 .. r_nlags (full-series mean, divisor n); constant series NULL.

    One tiled window hands each row the values before it, so the panel shuffles
    once whatever the number of lags.  Products are added up inside the tasks as
    one array per series; no row is multiplied.  A NULL counts as the mean.
    Lags a series is too short for are left out.
    """
    moments = df.groupBy("series_id").agg(F.count("value").alias("_n"), F.avg("value").alias("_mean"))
    centred = join_series(df, moments).select(
        "series_id", "ts", F.coalesce(F.col("value") - F.col("_mean"), F.lit(0.0)).alias("_c"), "_n"
    )
    names = [f"_l{k}" for k in range(1, nlags + 1)]
    recent = over_tiles(
        centred, lambda w: {f"_l{k}": F.lag("_c", k).over(w) for k in range(1, nlags + 1)}, step=step, back=nlags
    )
    c = F.col("_c")
    sums = recent.groupBy("series_id").agg(
        F.max("_n").alias("n"), F.sum(c * c).alias("_s"), *[F.sum(c * F.col(x)).alias(x) for x in names]
    )
    ratios = sums.select("series_id", "n", F.posexplode(F.array(*[F.struct(F.col(x).alias("sum"), F.try_divide(F.col(x), F.col("_s")).alias("acf")) for x in names])).alias("_k", "_v"))
    known = ratios.where(F.col("_v.sum").isNotNull())
    return known.select("series_id", "n", (F.col("_k") + 1).cast("bigint").alias("lag"), F.col("_v.acf").alias("acf"))


def dominant_lag(correlations: DataFrame) -> DataFrame:
    """The lag with the largest autocorrelation; the smallest such lag on ties."""
    best = F.max_by("lag", F.struct("acf", -F.col("lag")))
    return correlations.where(F.col("acf").isNotNull()).groupBy("series_id").agg(
        best.alias("dominant_lag"), F.max("acf").alias("acf")
    )


def partial_from_acf(r: Sequence[float] | None) -> list[float] | None:
    """Partial autocorrelations from r_1.. by the Durbin-Levinson recursion."""
    if r is None or any(x is None or np.isnan(x) for x in r):
        return None
    out, phi, scale = [], np.zeros(0), 1.0
    for k, rk in enumerate(r):
        past = np.asarray(r[:k])[::-1]
        new = (rk - phi @ past) / scale if scale > 0 else np.nan
        phi = np.append(phi - new * phi[::-1], new)
        scale *= 1 - new * new
        out.append(float(new))
    return out


def pacf(df: DataFrame, nlags: int, step: Step) -> DataFrame:
    """Partial autocorrelations 1 .. nlags from the biased autocorrelations."""
    r = acf(df, nlags, step)
    ordered = F.array_sort(F.collect_list(F.struct("lag", "acf")))
    rows = r.groupBy("series_id").agg(ordered.alias("_r"))

    @F.pandas_udf("array<double>")
    def levinson(r: pd.Series) -> pd.Series:
        return r.map(partial_from_acf)

    values = rows.select("series_id", levinson(F.transform("_r", lambda x: x["acf"])).alias("_v"))
    return values.select("series_id", F.posexplode("_v").alias("_k", "pacf")).select("series_id", (F.col("_k") + 1).cast("bigint").alias("lag"), "pacf")


def centred_mean(value: Column, w: WindowSpec, period: int) -> Column:
    """Centred moving average; an even period puts half weights on both ends; NULL at the edges."""
    half = period // 2
    frame = w.rowsBetween(-half, half)
    full = F.count(value).over(frame) == 2 * half + 1
    total = F.sum(value).over(frame)
    if period % 2 == 0:
        total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
    return F.when(full, total / period)


def decompose(df: DataFrame, period: int, step: Step, *, model: str = "additive") -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``resid`` (classical decomposition by moving averages).

    Seasonal values are the mean detrended value per position in the period,
    re-centred to mean 0 (additive) or 1 (multiplicative).  A series shorter
    than two periods gives no rows.
    """
    additive = model == "additive"
    v = F.col("value")
    half = period // 2
    trended = over_tiles(df, lambda w: {"trend": centred_mean(v, w, period)}, step=step, back=half, ahead=half)
    detrended = v - F.col("trend") if additive else F.try_divide(v, F.col("trend"))
    phase = F.pmod(grid_index(F.col("ts"), step), F.lit(period))
    trended = trended.withColumn("_phase", phase)
    per_phase = trended.groupBy("series_id", "_phase").agg(
        F.avg(detrended).alias("_s"), F.count(F.lit(1)).alias("_rows")
    )
    series = Window.partitionBy("series_id")
    centre = F.avg("_s").over(series)
    season = per_phase.select(
        "series_id",
        "_phase",
        (F.col("_s") - centre if additive else F.try_divide(F.col("_s"), centre)).alias("seasonal"),
        F.sum("_rows").over(series).alias("_n"),
    ).where(F.col("_n") >= 2 * period)
    table = season.groupBy("series_id").agg(F.map_from_entries(F.collect_list(F.struct("_phase", "seasonal"))).alias("_map"))
    joined = attach(row_tile(trended, step), table, source=row_tile(df, step))
    seasonal = F.col("_map")[F.col("_phase")]
    if additive:
        resid = v - F.col("trend") - F.col("seasonal")
    else:
        resid = F.try_divide(v, F.col("trend") * F.col("seasonal"))
    return joined.withColumn("seasonal", seasonal).select(*df.columns, "trend", "seasonal", resid.alias("resid"))


def seasonality_strength(parts: DataFrame) -> DataFrame:
    """max(0, 1 - Var(resid) / Var(seasonal + resid)) per series, on a decomposition."""
    known = F.col("resid").isNotNull()
    ratio = F.try_divide(
        F.var_samp(F.when(known, F.col("resid"))),
        F.var_samp(F.when(known, F.col("seasonal") + F.col("resid"))),
    )
    return parts.groupBy("series_id").agg(F.greatest(F.lit(0.0), 1 - ratio).alias("seasonality_strength"))


def qq_points(df: DataFrame, value: str = "value") -> DataFrame:
    """Each value with its normal quantile at plotting position i / (n + 1); ranks are those of ``ranked_values``."""
    p = F.col("i") / (F.col("n") + 1)
    return ranked_values(df, value=value).select("series_id", "i", "value", normal_quantile(p).alias("theoretical"))


def ljung_box(correlations: DataFrame) -> DataFrame:
    """Q = n (n + 2) sum r_k^2 / (n - k) over the lags given."""
    n = F.col("n")
    part = F.col("acf") * F.col("acf") / (n - F.col("lag"))
    return correlations.groupBy("series_id", "n").agg(F.sum(part).alias("_q")).select(
        "series_id", (n * (n + 2) * F.col("_q")).alias("ljung_box")
    )


def residual_moments(df: DataFrame, value: str = "value") -> DataFrame:
    """Per series: count, mean, sample deviation, skewness, excess kurtosis, Jarque-Bera."""
    m = df.groupBy("series_id").agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("kurtosis"),
    )
    s, k = F.col("skewness"), F.col("kurtosis")
    return m.withColumn("jarque_bera", F.col("n") / 6 * (s * s + k * k / 4))


def residual_diagnostics(df: DataFrame, nlags: int, step: Step) -> DataFrame:
    """Moments, Jarque-Bera and Ljung-Box of residuals in ``value``."""
    return residual_moments(df).join(ljung_box(acf(df, nlags, step)), "series_id")


def residual_histogram(df: DataFrame, bins: int = 20, limit: float = 4.0) -> DataFrame:
    """Counts of standardised residuals in equal bins on [-limit, limit]; tails in the outer bins."""
    z = F.col("zscore")
    edge = F.least(F.greatest(F.floor((z + limit) / (2 * limit) * bins), F.lit(0)), F.lit(bins - 1))
    return (
        zscore(df)
        .where(z.isNotNull())
        .groupBy("series_id", edge.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("bin_start", F.col("bin") * (2 * limit / bins) - limit)
    )


# MacKinnon (2010), one variable, constant only: b0 + b1/n + b2/n^2 + b3/n^3.
ADF_CRITICAL = {
    "crit_1": [-3.43035, -6.5393, -16.786, -79.433],
    "crit_5": [-2.86154, -2.8903, -4.234, -40.040],
    "crit_10": [-2.56677, -1.5384, -2.809, 0.0],
}

# MacKinnon (1994), approximate p-value, constant only.
ADF_P_SPLIT = -1.61
ADF_P_MAX = 2.74
ADF_P_MIN = -18.83
ADF_P_SMALL = [2.1659, 1.4412, 0.038269]
ADF_P_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]


def _adf_columns(t: Column, n: Column) -> dict[str, Column]:
    def poly(coefs: Sequence[float], x: Column) -> Column:
        out = F.lit(coefs[-1])
        for c in reversed(coefs[:-1]):
            out = out * x + c
        return out

    p = F.when(t > ADF_P_MAX, 1.0).when(t < ADF_P_MIN, 0.0)
    p = p.when(t <= ADF_P_SPLIT, normal_cdf(poly(ADF_P_SMALL, t))).otherwise(normal_cdf(poly(ADF_P_LARGE, t)))
    return {"p_value": F.when(t.isNotNull(), p)} | {name: poly(c, 1 / n) for name, c in ADF_CRITICAL.items()}


def adf_design(df: DataFrame, step: Step) -> DataFrame:
    """The panel with ``level``, the value before, and ``dy``, the change since."""
    v = F.col("value")
    return over_tiles(df, lambda w: {"level": F.lag(v, 1).over(w), "dy": v - F.lag(v, 1).over(w)}, step=step, back=1)


def usable_lags(n: Column) -> Column:
    """ceil(12 (n / 100)^(1/4)), less for series with too few values for so many regressors."""
    return F.greatest(F.lit(0), F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))), F.floor(n / 2) - 2)).cast("int")


def adf_test(df: DataFrame, step: Step, *, maxlag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant; the number of lags by AIC.

    All orders 0..maxlag are compared on the same rows, then the chosen one is
    fitted again on its longest sample.  ``maxlag`` None takes ``usable_lags`` of
    each series' number of values.  One tiled design serves all regressions.
    """
    sizes = df.groupBy("series_id").agg((usable_lags(F.count("value")) if maxlag is None else F.lit(maxlag)).alias("_limit"))
    # One number: the widest design any series needs.
    widest = maxlag if maxlag is not None else sizes.agg(F.max("_limit")).first()[0] or 0
    d = F.col("dy")
    design = over_tiles(
        adf_design(df, step),
        lambda w: {"z": F.array("level", *[F.lag(d, k).over(w) for k in range(1, widest + 1)], d)},
        step=step,
        back=widest,
    ).where(d.isNotNull())
    # Each series is compared with its own number of lags; columns beyond it are zero, so no row is lost to them.
    sums = vector_sums(join_series(design, sizes), widest + 1, fixed=1, limit="_limit")
    chosen = best_nested(join_series(sums, sizes), 2, widest + 2)
    chosen = chosen.select("series_id", F.col("extra").alias("lags")).where(F.col("lags").isNotNull())
    keys = ["series_id", "lags"]
    final = solved(vector_sums(join_series(design, chosen), widest + 1, keys=keys, fixed=1, limit="lags"), widest + 1, keys=keys)
    out = final.select(*keys, "n", F.col("t")[1].alias("adf"), F.col("beta")[1].alias("gamma"))
    return out.withColumns(_adf_columns(F.col("adf"), F.col("n")))


def adf_lag0(df: DataFrame, step: Step) -> DataFrame:
    """The test without lagged changes, from built-in regression aggregates only."""
    design = adf_design(df, step).where(F.col("dy").isNotNull())
    x, y = F.col("level"), F.col("dy")
    fit = design.groupBy("series_id").agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("gamma"),
        F.regr_sxx(y, x).alias("_sxx"),
        F.regr_syy(y, x).alias("_syy"),
        F.regr_sxy(y, x).alias("_sxy"),
    )
    sse = F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx")
    se = F.sqrt(sse / (F.col("n") - 2) / F.col("_sxx"))
    out = fit.select("series_id", "n", "gamma", F.try_divide(F.col("gamma"), se).alias("adf"))
    return out.withColumns(_adf_columns(F.col("adf"), F.col("n")))


def check_stats(df: DataFrame, nlags: int, step: Step) -> DataFrame:
    """Per series: counts, centre, spread, shape, share of distinct values, unit root, autocorrelation.

    ``adf`` is the statistic of ``adf_test`` with as many lags as its usual rule gives.
    """
    base = df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.try_divide(F.count_distinct("value"), F.count("value")).alias("distinct_share"),
    )
    median = exact_quantiles(df, [0.5]).select("series_id", F.col("q")[0].alias("median"))
    shape = residual_moments(df).drop("n")
    unit_root = adf_test(df, step).select("series_id", F.col("lags").cast("bigint").alias("adf_lags"), "adf")
    return merge_tables([base, median, shape, unit_root, ljung_box(acf(df, nlags, step))])
