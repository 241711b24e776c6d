"""The forecast table every later step reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.schema import FORECAST_COLUMNS, require_columns


def to_contract(df: DataFrame, model_version: str, forecast_ts: Column | None = None) -> DataFrame:
    """Seven columns in fixed order and type, with ``lower`` <= ``upper``."""
    require_columns(df, "series_id", "ts", "yhat", "lower", "upper")
    made = forecast_ts if forecast_ts is not None else F.col("origin_ts")
    full = df.withColumns(
        {
            "asset_id": F.col("series_id"),
            "timestamp": F.col("ts"),
            "lower": F.least("lower", "upper"),
            "upper": F.greatest("lower", "upper"),
            "model_version": F.lit(model_version),
            "forecast_ts": made,
        }
    )
    return full.select(*[F.col(n).cast(t).alias(n) for n, t in FORECAST_COLUMNS])


def check_contract(df: DataFrame) -> DataFrame:
    """Fail on a frame that does not follow the format; the rows pass unchanged."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if got != FORECAST_COLUMNS:
        raise TypeError(f"forecast columns {got}, wanted {FORECAST_COLUMNS}")
    return df
