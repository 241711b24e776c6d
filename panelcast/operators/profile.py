"""Behaviour fingerprints of series, and rules that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.operators.daily import coefficient_of_variation, intermittency_ratio, peak_to_avg_ratio
from panelcast.operators.stats import acf, decompose, seasonality_strength
from panelcast.plans.grid import Step
from panelcast.plans.tiles import merge_tables, over_tiles

FEATURES = [
    "mean_load", "variance", "cv", "acf_1", "seasonality_strength", "intermittency",
    "peak_to_avg", "ramp_frequency", "ramp_size", "forecast_rmse", "interval_width",
]


def fingerprint(df: DataFrame, step: Step, *, period: int, ramp_threshold: float, eps: float = 1e-6) -> DataFrame:
    """One row per series of a regular panel.

    Ramp frequency is the share of steps whose absolute ramp exceeds the
    threshold.  The forecast error is that of repeating the last period, and the
    interval width the middle 80 % of those errors.
    """
    v = F.col("value")
    steps = over_tiles(
        df,
        lambda w: {"_ramp": F.abs(v - F.lag(v).over(w)), "_error": v - F.lag(v, period).over(w)},
        step=step,
        back=period,
    )
    ramp, e = F.col("_ramp"), F.col("_error")
    q = F.percentile(e, F.array(F.lit(0.1), F.lit(0.9)))
    base = steps.groupBy("series_id").agg(
        F.avg(v).alias("mean_load"),
        F.var_samp(v).alias("variance"),
        coefficient_of_variation(F.stddev_samp(v), F.avg(v)).alias("cv"),
        intermittency_ratio(v, eps).alias("intermittency"),
        peak_to_avg_ratio(F.max(v), F.avg(v)).alias("peak_to_avg"),
        F.avg((ramp > ramp_threshold).cast("double")).alias("ramp_frequency"),
        F.avg(ramp).alias("ramp_size"),
        F.sqrt(F.avg(e * e)).alias("forecast_rmse"),
        (q[1] - q[0]).alias("interval_width"),
    )
    first_lag = acf(df, 1, step).select("series_id", F.col("acf").alias("acf_1"))
    strength = seasonality_strength(decompose(df, period, step))
    return merge_tables([base, first_lag, strength]).select("series_id", *FEATURES)


def classify_series(
    prints: DataFrame, *, seasonality: float = 0.6, steady_cv: float = 0.5, zeros: float = 0.3, wild_cv: float = 2.0
) -> DataFrame:
    """Class and model per series: C many zeros, A steady and seasonal, otherwise B.

    ``variability`` names the band of the coefficient of variation.
    """
    cv = F.col("cv")
    group = F.when(F.col("intermittency") >= zeros, "C").when(
        (F.col("seasonality_strength") >= seasonality) & (cv < steady_cv), "A"
    )
    group = group.otherwise("B")
    model = F.when(group == "A", "sarima").when(group == "B", "gbdt").otherwise("quantile")
    band = F.when(cv < steady_cv, "low").when(cv < wild_cv, "medium").otherwise("high")
    return prints.select("series_id", group.alias("group"), model.alias("model"), band.alias("variability"))


def cluster_stability(before: DataFrame, after: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Transition counts between two assignments, with the share of all series that changed."""
    joined = before.select("series_id", F.col(cluster).alias("from_cluster")).join(
        after.select("series_id", F.col(cluster).alias("to_cluster")), "series_id"
    )
    counts = joined.groupBy("from_cluster", "to_cluster").agg(F.count(F.lit(1)).alias("n_series"))
    everything = Window.partitionBy()
    moved: Column = F.when(F.col("from_cluster") != F.col("to_cluster"), F.col("n_series")).otherwise(0)
    share = F.sum(moved).over(everything) / F.sum("n_series").over(everything)
    return counts.withColumn("share_changed", share)
