"""Daily energy, ramp and variability metrics, and panel summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.plans.grid import DAY, grid_index
from panelcast.plans.quantiles import exact_quantiles
from panelcast.plans.tiles import previous_row
from panelcast.schema import DAILY_COLUMNS, require_columns


def daily_energy_metrics(df: DataFrame) -> DataFrame:
    """Sum, extremes, mean, sample deviation and count of known values per series and day."""
    return df.groupBy("series_id", F.to_date("ts").alias("date")).agg(*_energy())


def _energy() -> list[Column]:
    v = F.col("value")
    return [
        F.sum(v).alias("daily_energy_kwh"),
        F.max(v).alias("daily_peak_kw"),
        F.min(v).alias("daily_min_kw"),
        F.avg(v).alias("daily_avg_kw"),
        F.stddev_samp(v).alias("daily_std_kw"),
        F.count(v).alias("n_samples"),
    ]


def ramp(df: DataFrame, *, tile_seconds: int = DAY) -> DataFrame:
    """Change from the row before in the same series, across midnight; first row NULL."""
    change = F.col("value") - F.col("prev_value")
    return (
        previous_row(df, ["value"], tile_seconds=tile_seconds)
        .withColumns({"ramp_kw": change, "abs_ramp_kw": F.abs(change)})
        .drop("prev_value")
    )


def coefficient_of_variation(std: Column, mean: Column) -> Column:
    """std / mean for a positive mean, else 0 (a missing mean counts as not positive)."""
    return F.when(mean > 0, std / mean).otherwise(F.lit(0.0))


def peak_to_avg_ratio(peak: Column, avg: Column) -> Column:
    return peak / F.when(avg > 0, avg).otherwise(F.lit(1.0))


def intermittency_ratio(value: Column, eps: float | None = None) -> Column:
    """Aggregate: share of rows that are zero, or within ``eps`` of it; NULL rows count below the line."""
    hit = value == 0 if eps is None else F.abs(value) < eps
    return F.try_divide(F.count_if(hit).cast("double"), F.count(F.lit(1)))


def _tile_moments(df: DataFrame, tile_seconds: int) -> DataFrame:
    """One row per series and time tile, with value and ramp moments and the ramp into the tile.

    Rows shuffle once, on (series, tile); that serves the lag and the aggregate.
    The ramp into a tile's first row needs the last row of the series' previous
    tile, which the tile rows themselves supply.

    First and last rows are found as least and largest structs, which Spark
    aggregates along the order that the lag has sorted rows into: a task then
    holds one tile's sums at a time, not a table of all its tiles.
    """
    require_columns(df, "series_id", "ts", "value")
    tiled = df.select("series_id", grid_index(F.col("ts"), tile_seconds).alias("_tile"), "ts", "value")
    inside = Window.partitionBy("series_id", "_tile").orderBy("ts")
    rows = tiled.withColumn("_ramp", F.col("value") - F.lag("value").over(inside))
    v, ramp = F.col("value"), F.col("_ramp")
    placed = F.when(F.col("ts").isNotNull(), F.struct("ts", "value"))
    tiles = rows.groupBy("series_id", "_tile").agg(
        F.sum(v).alias("_sum"),
        F.max(v).alias("_max"),
        F.min(v).alias("_min"),
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(v == 0).alias("_zeros"),
        F.count(v).alias("_vn"),
        F.avg(v).alias("_vm"),
        (F.var_pop(v) * F.count(v)).alias("_vq"),
        F.count(ramp).alias("_rn"),
        F.avg(ramp).alias("_rm"),
        (F.var_pop(ramp) * F.count(ramp)).alias("_rq"),
        F.max(F.abs(ramp)).alias("_rmax"),
        F.sum(F.abs(ramp)).alias("_rabs"),
        F.min(placed).alias("_first"),
        F.max(placed)["value"].alias("_last"),
    )
    order = Window.partitionBy("series_id").orderBy("_tile")
    edge = F.col("_first.value") - F.lag("_last").over(order)
    return tiles.withColumns({"date": F.to_date("_first.ts"), "_edge": edge})


def _daily(df: DataFrame, tile_seconds: int) -> DataFrame:
    """Merge tiles to days: sums add, squares are taken around the day's mean (parallel variance formula)."""
    if DAY % tile_seconds:
        raise ValueError("a tile must divide the day")
    if tile_seconds == DAY and df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC":
        return _whole_days(_tile_moments(df, tile_seconds))
    day = Window.partitionBy("series_id", "date")
    edge, has_edge = F.col("_edge"), F.when(F.col("_edge").isNotNull(), 1).otherwise(0)
    ramp_sum = F.coalesce(F.col("_rm") * F.col("_rn"), F.lit(0.0)) + F.coalesce(edge, F.lit(0.0))
    tiles = _tile_moments(df, tile_seconds).withColumns(
        {
            "_vmean": F.try_divide(F.sum("_sum").over(day), F.sum("_vn").over(day)),
            "_rcount": F.sum(F.col("_rn") + has_edge).over(day),
            "_rmean": F.try_divide(F.sum(ramp_sum).over(day), F.sum(F.col("_rn") + has_edge).over(day)),
        }
    )
    zero = F.lit(0.0)
    v_off, r_off, e_off = F.col("_vm") - F.col("_vmean"), F.col("_rm") - F.col("_rmean"), edge - F.col("_rmean")
    v_square = F.sum(F.col("_vq") + F.col("_vn") * v_off * v_off)
    r_square = F.sum(
        F.coalesce(F.col("_rq") + F.col("_rn") * r_off * r_off, zero) + F.coalesce(e_off * e_off, zero)
    )
    vn, rn = F.sum("_vn"), F.max("_rcount")
    return tiles.groupBy("series_id", "date").agg(
        F.sum("_sum").alias("daily_energy_kwh"),
        F.max("_max").alias("daily_peak_kw"),
        F.min("_min").alias("daily_min_kw"),
        F.max("_vmean").alias("daily_avg_kw"),
        F.when(vn > 1, F.sqrt(F.try_divide(v_square, vn - 1))).alias("daily_std_kw"),
        vn.alias("n_samples"),
        F.max("_rmean").alias("mean_ramp_kw"),
        F.when(rn > 1, F.sqrt(F.try_divide(r_square, rn - 1))).alias("std_ramp_kw"),
        F.max(F.greatest("_rmax", F.abs(edge))).alias("max_abs_ramp_kw"),
        F.try_divide(F.sum(F.coalesce("_rabs", zero) + F.coalesce(F.abs(edge), zero)), rn).alias("mean_abs_ramp_kw"),
        F.try_divide(F.sum("_zeros").cast("double"), F.sum("_rows")).alias("intermittency_ratio"),
    )


def _whole_days(tiles: DataFrame) -> DataFrame:
    """As :func:`_daily`, for tiles that are the days: nothing is left to merge but the ramp into the day."""
    zero, edge, vn = F.lit(0.0), F.col("_edge"), F.col("_vn")
    rn = F.col("_rn") + F.when(edge.isNotNull(), 1).otherwise(0)
    mean = F.try_divide(F.coalesce(F.col("_rm") * F.col("_rn"), zero) + F.coalesce(edge, zero), rn)
    tiles = tiles.withColumns({"_vmean": F.try_divide("_sum", vn), "_rcount": rn, "_rmean": mean})
    v_off, r_off, e_off = F.col("_vm") - F.col("_vmean"), F.col("_rm") - F.col("_rmean"), edge - F.col("_rmean")
    v_square, rn = F.col("_vq") + vn * v_off * v_off, F.col("_rcount")
    r_square = F.coalesce(F.col("_rq") + F.col("_rn") * r_off * r_off, zero) + F.coalesce(e_off * e_off, zero)
    return tiles.select(
        "series_id",
        "date",
        F.col("_sum").alias("daily_energy_kwh"),
        F.col("_max").alias("daily_peak_kw"),
        F.col("_min").alias("daily_min_kw"),
        F.col("_vmean").alias("daily_avg_kw"),
        F.when(vn > 1, F.sqrt(F.try_divide(v_square, vn - 1))).alias("daily_std_kw"),
        vn.alias("n_samples"),
        F.col("_rmean").alias("mean_ramp_kw"),
        F.when(rn > 1, F.sqrt(F.try_divide(r_square, rn - 1))).alias("std_ramp_kw"),
        F.greatest("_rmax", F.abs(edge)).alias("max_abs_ramp_kw"),
        F.try_divide(F.coalesce("_rabs", zero) + F.coalesce(F.abs(edge), zero), rn).alias("mean_abs_ramp_kw"),
        F.try_divide(F.col("_zeros").cast("double"), "_rows").alias("intermittency_ratio"),
    )


def daily_ramp_metrics(df: DataFrame, *, tile_seconds: int = DAY) -> DataFrame:
    """Signed mean, sample deviation, largest and mean absolute ramp per series and day."""
    return _daily(df, tile_seconds).select(
        "series_id", "date", "mean_ramp_kw", "std_ramp_kw", "max_abs_ramp_kw", "mean_abs_ramp_kw"
    )


def daily_metrics(df: DataFrame, *, tile_seconds: int = DAY) -> DataFrame:
    """The daily fact table.  Units are those of the input; nothing is converted.

    A task works on one tile of one series at a time.  A day suits half-hourly
    data; for series with very many rows a day choose an hour or less.
    """
    mean, std = F.col("daily_avg_kw"), F.col("daily_std_kw")
    return (
        _daily(df, tile_seconds)
        .withColumns(
            {
                "coefficient_of_variation": coefficient_of_variation(std, mean),
                "peak_to_avg_ratio": peak_to_avg_ratio(F.col("daily_peak_kw"), mean),
            }
        )
        .select(*DAILY_COLUMNS)
    )


def daily_variability(df: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Coefficient of variation, zero share and near-zero share per series and day."""
    return (
        df.groupBy("series_id", F.to_date("ts").alias("date"))
        .agg(
            coefficient_of_variation(F.stddev_samp("value"), F.avg("value")).alias("coefficient_of_variation"),
            intermittency_ratio(F.col("value")).alias("intermittency_ratio"),
            intermittency_ratio(F.col("value"), eps).alias("near_zero_ratio"),
            peak_to_avg_ratio(F.max("value"), F.avg("value")).alias("peak_to_avg_ratio"),
        )
    )


def series_summary(df: DataFrame, category: str | None = None) -> DataFrame:
    """Per series: smallest category label, extremes, mean, deviation, count."""
    aggs = [] if category is None else [F.min(category).alias("category")]
    return df.groupBy("series_id").agg(
        *aggs,
        F.min("value").alias("min_kw"),
        F.avg("value").alias("mean_kw"),
        F.max("value").alias("max_kw"),
        F.stddev_samp("value").alias("std_kw"),
        F.count("ts").alias("n_samples"),
    )


def daily_summary_by_series(daily: DataFrame) -> DataFrame:
    """Means (and the deviation of energy) of the daily table per series."""
    return daily.groupBy("series_id").agg(
        F.avg("daily_energy_kwh").alias("avg_daily_energy_kwh"),
        F.stddev_samp("daily_energy_kwh").alias("std_daily_energy_kwh"),
        F.avg("daily_peak_kw").alias("avg_daily_peak_kw"),
        F.avg("coefficient_of_variation").alias("avg_cv"),
        F.avg("peak_to_avg_ratio").alias("avg_peak_ratio"),
        F.avg("mean_ramp_kw").alias("avg_ramp_kw"),
    )


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """One row per value with its number of rows; a list on the driver is the caller's choice."""
    return df.groupBy(F.col(column).alias("item")).agg(F.count(F.lit(1)).alias("n_rows"))


def quantiles(df: DataFrame, probs: Sequence[float]) -> DataFrame:
    """One row per series and probability, by linear interpolation between order statistics."""
    table = exact_quantiles(df, probs)
    pairs = [F.struct(F.lit(float(p)).alias("prob"), F.col("q")[j].alias("quantile")) for j, p in enumerate(probs)]
    return table.select("series_id", F.inline(F.array(*pairs)))


def cross_section_band(df: DataFrame, group: str) -> DataFrame:
    """Per time and group of series: mean and the band of one population deviation."""
    mean, sd = F.avg("value"), F.stddev_pop("value")
    return df.groupBy("ts", group).agg(
        F.count("value").alias("n_series"),
        mean.alias("mean"),
        sd.alias("std"),
        (mean - sd).alias("lower"),
        (mean + sd).alias("upper"),
    )
