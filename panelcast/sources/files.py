"""Files: CSV series, parquet tables, fitted models."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelcast.schema import SERIES, clean_double, require_columns


def read_series_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    ts_col: str,
    value_col: str,
    ts_format: str = "yyyy-MM-dd",
    series_id: str | None = None,
    series_col: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """CSV files with a header line, one series per file unless ``series_id`` or ``series_col`` names it.

    All columns are read as text under a declared schema and then parsed, so a
    bad cell gives NULL instead of another column type.  ``columns`` lists the
    file's columns in order; the default is the series (if it has a column), the
    time and the value.  The series is named after its file without the ``.csv``
    ending.  Lines without a usable time are left out; ``csv_report`` counts
    them.
    """
    lines = _csv_lines(spark, path, ts_col, value_col, ts_format, series_id, series_col, columns)
    return lines.where(F.col("ts").isNotNull()).select("series_id", "ts", "value")


def csv_report(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """What :func:`read_series_csv` makes of every line, per file and ``outcome``, as ``n_lines``.

    Outcomes: ``read``, ``no_value`` and ``bad_value`` (read with a NULL value), ``no_time`` and ``bad_time`` (left out).
    They add up to the lines below the headers.  Files without lines have no row.
    """
    defaults = {"ts_format": "yyyy-MM-dd", "series_id": None, "series_col": None, "columns": None}
    return _csv_lines(spark, path, **(defaults | options)).groupBy("file", "outcome").agg(F.count(F.lit(1)).alias("n_lines"))


def _csv_lines(
    spark: SparkSession,
    path: str | list[str],
    ts_col: str,
    value_col: str,
    ts_format: str,
    series_id: str | None,
    series_col: str | None,
    columns: list[str] | None,
) -> DataFrame:
    """``file, series_id, ts, value, outcome`` of every line."""
    names = columns or [c for c in (series_col, ts_col, value_col) if c]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", True).csv(path)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    sid = F.lit(series_id) if series_id is not None else F.col(series_col) if series_col else stem
    parsed = F.try_to_timestamp(F.trim(F.col(ts_col)), F.lit(ts_format)).cast("timestamp_ntz")
    number = F.expr(f"try_cast(trim(`{value_col}`) AS double)")
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    outcome = F.when(parsed.isNull(), F.when(blank(ts_col), "no_time").otherwise("bad_time"))
    outcome = outcome.when(number.isNull(), F.when(blank(value_col), "no_value").otherwise("bad_value")).otherwise("read")
    return raw.select(
        F.col("_metadata.file_name").alias("file"),
        sid.alias("series_id"),
        parsed.alias("ts"),
        clean_double(number).alias("value"),
        outcome.alias("outcome"),
    )


def read_series_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A series table; a column of another type is an error, not a silent cast."""
    df = spark.read.parquet(path)
    require_columns(df, *SERIES.names)
    for field in SERIES.fields:
        if df.schema[field.name].dataType != field.dataType:
            raise TypeError(f"{field.name}: {df.schema[field.name].dataType}, wanted {field.dataType}")
    return df


def write_series(df: DataFrame, path: str, *, partition_by: str | None = "date", mode: str = "overwrite") -> None:
    """Parquet split by day (or by another column) so that later reads prune files."""
    if partition_by == "date" and "date" not in df.columns:
        df = df.withColumn("date", F.to_date("ts"))
    _write(df, path, partition_by, mode)


def write_daily(df: DataFrame, path: str, *, partition_by: str | None = "date", mode: str = "overwrite") -> None:
    _write(df, path, partition_by, mode)


def _write(df: DataFrame, path: str, partition_by: str | None, mode: str) -> None:
    if partition_by:
        # Salted so that one hot day is written by several tasks, yet each
        # folder gets few files.
        salt = F.pmod(F.hash("series_id"), F.lit(32))
        df = df.repartition(F.col(partition_by), salt)
        df.sortWithinPartitions(partition_by, "series_id").write.mode(mode).partitionBy(partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_series_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV files with a header line, one per task."""
    df.write.mode(mode).option("header", True).csv(path)


def save_model(model: Any, path: str) -> None:
    """A fitted MLlib model, or a parameter table, below ``path``."""
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str, kind: type | None = None) -> Any:
    """Read back what :func:`save_model` wrote; ``kind`` is the MLlib model class."""
    if kind is None:
        return spark.read.parquet(path)
    return kind.load(path)
