"""Structured Streaming forms of the operators that need no earlier rows.

Ramps are left to the batch table: they depend on the row before, whenever it
arrives.  Watermarks need timestamps with a zone, so rows without one are read
as UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelcast.operators.daily import coefficient_of_variation, intermittency_ratio, peak_to_avg_ratio


def stream_daily_energy(stream: DataFrame, *, lateness: str = "1 hour") -> DataFrame:
    """Daily energy metrics per series; a day is final once the watermark has passed its end."""
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    v = F.col("value")
    days = rows.groupBy("series_id", F.window("ts", "1 day").alias("_day")).agg(
        F.sum(v).alias("daily_energy_kwh"),
        F.max(v).alias("daily_peak_kw"),
        F.min(v).alias("daily_min_kw"),
        F.avg(v).alias("daily_avg_kw"),
        F.stddev_samp(v).alias("daily_std_kw"),
        F.count(v).alias("n_samples"),
        coefficient_of_variation(F.stddev_samp(v), F.avg(v)).alias("coefficient_of_variation"),
        intermittency_ratio(v).alias("intermittency_ratio"),
        peak_to_avg_ratio(F.max(v), F.avg(v)).alias("peak_to_avg_ratio"),
    )
    return days.withColumn("date", F.to_date("_day.start")).drop("_day")


def stream_residual_anomalies(stream: DataFrame, forecast: DataFrame) -> DataFrame:
    """Rows of the stream outside the interval of a stored forecast (stream-static join)."""
    f = forecast.select(F.col("asset_id").alias("series_id"), F.col("timestamp").alias("ts"), "yhat", "lower", "upper")
    rows = stream.select("series_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value").join(f, ["series_id", "ts"])
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return rows.where(outside).withColumn("resid", F.col("value") - F.col("yhat"))
