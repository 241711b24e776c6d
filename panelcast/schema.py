"""Canonical column sets and small guards shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SERIES = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

# The published forecast table format.
FORECAST_COLUMNS = [
    ("asset_id", "string"),
    ("timestamp", "timestamp_ntz"),
    ("yhat", "double"),
    ("lower", "double"),
    ("upper", "double"),
    ("model_version", "string"),
    ("forecast_ts", "timestamp_ntz"),
]

# The published daily table format, plus mean_abs_ramp_kw.
DAILY_COLUMNS = [
    "series_id",
    "date",
    "daily_energy_kwh",
    "daily_peak_kw",
    "daily_min_kw",
    "daily_avg_kw",
    "daily_std_kw",
    "n_samples",
    "mean_ramp_kw",
    "std_ramp_kw",
    "max_abs_ramp_kw",
    "mean_abs_ramp_kw",
    "coefficient_of_variation",
    "intermittency_ratio",
    "peak_to_avg_ratio",
]

EVAL_COLUMNS = ["series_id", "model", "origin_ts", "horizon", "ts", "actual", "forecast", "error"]

ANOMALY_COLUMNS = ["series_id", "ts", "value", "method", "score", "lower", "upper"]


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail early, before any job runs, when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")


def clean_double(col: Column) -> Column:
    """NaN becomes NULL: Spark sorts and compares NaN as an ordinary value."""
    v = col.cast("double")
    return F.when(~F.isnan(v), v)


def select_eval(df: DataFrame) -> DataFrame:
    return df.select(*EVAL_COLUMNS)


def select_anomaly(df: DataFrame) -> DataFrame:
    return df.select(*ANOMALY_COLUMNS)
