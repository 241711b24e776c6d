"""Between wide and long frames, and into the canonical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelcast.schema import clean_double, require_columns


def canonicalize(df: DataFrame, mapping: dict[str, str], extra: Sequence[str] = ()) -> DataFrame:
    """Pick and rename columns into ``series_id, ts, value`` (+ ``extra``).

    ``mapping`` goes from canonical name to source column; nested fields may be
    named with a dot.  Without a source for ``series_id`` the frame is one series.
    """
    sid = F.col(mapping["series_id"]).cast("string") if "series_id" in mapping else F.lit("series")
    return df.select(
        sid.alias("series_id"),
        F.col(mapping["ts"]).cast("timestamp_ntz").alias("ts"),
        clean_double(F.col(mapping["value"])).alias("value"),
        *[F.col(mapping.get(c, c)).alias(c) for c in extra],
    )


def to_long(df: DataFrame, value_cols: Sequence[str], *, ts: str = "ts") -> DataFrame:
    """One row per time and column; the column's name becomes the series."""
    require_columns(df, ts, *value_cols)
    cols = [F.col(c).cast("double").alias(c) for c in value_cols]
    return df.select(ts, *cols).unpivot(ts, list(value_cols), "series_id", "value")


def to_wide(df: DataFrame, series: Sequence[str], *, ts: str = "ts", value: str = "value") -> DataFrame:
    """One column per named series.  The names are given, so no extra job finds them."""
    return df.groupBy(ts).pivot("series_id", list(series)).agg(F.first(value, ignorenulls=True))
