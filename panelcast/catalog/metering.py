"""Daily metering queries and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.registry import query
from panelcast.operators import daily

RAMP = """r AS (SELECT series_id, ts, value, CAST(ts AS DATE) AS date,
  value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS ramp FROM u)"""

DAILY = """dm AS (SELECT series_id, date, sum(value) AS daily_energy_kwh, max(value) AS daily_peak_kw, min(value) AS daily_min_kw,
  avg(value) AS daily_avg_kw, stddev_samp(value) AS daily_std_kw, count(value) AS n_samples, avg(ramp) AS mean_ramp_kw,
  stddev_samp(ramp) AS std_ramp_kw, max(abs(ramp)) AS max_abs_ramp_kw, avg(abs(ramp)) AS mean_abs_ramp_kw,
  CASE WHEN avg(value) > 0 THEN stddev_samp(value) / avg(value) ELSE 0 END AS coefficient_of_variation,
  count(*) FILTER (value = 0) / count(*) AS intermittency_ratio,
  max(value) / CASE WHEN avg(value) > 0 THEN avg(value) ELSE 1 END AS peak_to_avg_ratio
  FROM r GROUP BY 1, 2)"""

NUMBERS = [
    "daily_energy_kwh", "daily_peak_kw", "daily_min_kw", "daily_avg_kw", "daily_std_kw", "mean_ramp_kw", "std_ramp_kw",
    "max_abs_ramp_kw", "mean_abs_ramp_kw", "coefficient_of_variation", "intermittency_ratio", "peak_to_avg_ratio",
]


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


@query("daily_metrics", v.with_(v.U, RAMP, DAILY) + f"SELECT series_id, date, n_samples, {r6(*NUMBERS)} FROM dm")
def _(spark, sf):
    return daily.daily_metrics(v.user_events(spark, sf))


@query("daily_energy", v.with_(v.U, RAMP, DAILY) + f"SELECT series_id, date, n_samples, {r6(*NUMBERS[:5])} FROM dm")
def _(spark, sf):
    return daily.daily_energy_metrics(v.user_events(spark, sf))


@query("ramp", v.with_(v.U, RAMP) + "SELECT series_id, ts, round(value, 6) AS value, round(ramp, 6) AS ramp_kw, round(abs(ramp), 6) AS abs_ramp_kw FROM r")
def _(spark, sf):
    return daily.ramp(v.user_events(spark, sf))


@query("daily_ramp", v.with_(v.U, RAMP, DAILY) + f"SELECT series_id, date, {r6(*NUMBERS[5:9])} FROM dm")
def _(spark, sf):
    return daily.daily_ramp_metrics(v.user_events(spark, sf))


@query("daily_variability", v.with_(v.T) + """
SELECT series_id, CAST(ts AS DATE) AS date,
  round(CASE WHEN avg(value) > 0 THEN stddev_samp(value) / avg(value) ELSE 0 END, 6) AS coefficient_of_variation,
  round(count(*) FILTER (value = 0) / count(*), 6) AS intermittency_ratio,
  round(count(*) FILTER (abs(value) < 1.0) / count(*), 6) AS near_zero_ratio,
  round(max(value) / CASE WHEN avg(value) > 0 THEN avg(value) ELSE 1 END, 6) AS peak_to_avg_ratio FROM t GROUP BY 1, 2""")
def _(spark, sf):
    return daily.daily_variability(v.hourly(spark, sf), eps=1.0)


@query("series_summary", v.with_(v.U) + """
SELECT series_id, min(event_type) AS category, round(min(value), 6) AS min_kw, round(avg(value), 6) AS mean_kw,
  round(max(value), 6) AS max_kw, round(stddev_samp(value), 6) AS std_kw, count(ts) AS n_samples FROM u GROUP BY 1""")
def _(spark, sf):
    return daily.series_summary(v.user_events(spark, sf, "event_type"), category="event_type")


@query("daily_summary", v.with_(v.U, RAMP, DAILY) + """
SELECT series_id, round(avg(daily_energy_kwh), 6) AS avg_daily_energy_kwh, round(stddev_samp(daily_energy_kwh), 6) AS std_daily_energy_kwh,
  round(avg(daily_peak_kw), 6) AS avg_daily_peak_kw, round(avg(coefficient_of_variation), 6) AS avg_cv,
  round(avg(peak_to_avg_ratio), 6) AS avg_peak_ratio, round(avg(mean_ramp_kw), 6) AS avg_ramp_kw FROM dm GROUP BY 1""")
def _(spark, sf):
    return daily.daily_summary_by_series(daily.daily_metrics(v.user_events(spark, sf)))


@query("supplier_daily_metrics", """
WITH u AS (SELECT CAST(l_suppkey AS VARCHAR) AS series_id, l_shipdate AS ts, sum(l_extendedprice * (1 - l_discount)) AS value FROM lineitem GROUP BY 1, 2),
""" + RAMP + ", " + DAILY + "SELECT series_id, date, n_samples, " + ", ".join(f"round({n}, 4) AS {n}" for n in NUMBERS) + " FROM dm", digits=4)
def _(spark, sf):
    from panelcast.operators.clean import to_cells
    from panelcast.plans.grid import DAY, grid_time

    cells = to_cells(v.supplier_revenue(spark, sf), DAY)
    days = cells.select("series_id", grid_time(F.col("_cell"), DAY).alias("ts"), "value")
    return daily.daily_metrics(days)


@query("distinct_count", "SELECT count(DISTINCT user_id) AS n_distinct FROM events")
def _(spark, sf):
    return daily.distinct_count(v.user_events(spark, sf), "series_id")


@query("distinct_values", "SELECT event_type AS item, count(*) AS n_rows FROM events GROUP BY 1")
def _(spark, sf):
    return daily.distinct_values(v.user_events(spark, sf, "event_type"), "event_type")


@query("quantiles", """
SELECT event_type AS series_id, CAST(prob AS DOUBLE) AS prob, round(quantile, 6) AS quantile FROM (
  SELECT event_type, unnest([0.025, 0.25, 0.5, 0.75, 0.975]) AS prob, unnest(quantile_cont(value, [0.025, 0.25, 0.5, 0.75, 0.975])) AS quantile
  FROM events GROUP BY 1)""")
def _(spark, sf):
    return daily.quantiles(v.type_events(spark, sf), [0.025, 0.25, 0.5, 0.75, 0.975])


@query("cross_section_band", v.with_(v.U) + """,
h AS (SELECT series_id, date_trunc('day', ts)::TIMESTAMP AS ts, sum(value) AS value, min(event_type) AS category FROM u GROUP BY 1, 2)
SELECT ts, category, count(value) AS n_series, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
  round(avg(value) - stddev_pop(value), 6) AS lower, round(avg(value) + stddev_pop(value), 6) AS upper FROM h GROUP BY 1, 2""".replace("\n,", ",", 1))
def _(spark, sf):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    per_day = v.user_events(spark, sf, "event_type").groupBy("series_id", day.alias("ts")).agg(
        F.sum("value").alias("value"), F.min("event_type").alias("category")
    )
    return daily.cross_section_band(per_day, "category")
