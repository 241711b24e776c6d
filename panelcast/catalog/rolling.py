"""Lag and rolling feature queries on the hourly panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.registry import query
from panelcast.operators import windows
from panelcast.operators.clean import regularize
from panelcast.plans.grid import HOUR

W = "WINDOW w AS (PARTITION BY series_id ORDER BY ts)"


def lag_sql(lags) -> str:
    return ", ".join(f"round(lag(value, {k}) OVER w, 6) AS lag_{k}" for k in lags)


def before_sql(sizes) -> str:
    return ", ".join(
        f"round(avg(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING), 6) AS rmean_{k}"
        for k in sizes
    )


def strict_sql(k: int, name: str, value: str = "value", key: str = "series_id") -> str:
    frame = f"OVER (PARTITION BY {key} ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) {frame} = {k} THEN avg({value}) {frame} END AS {name}"


@query("lag_features", v.with_(v.T) + f"SELECT series_id, ts, value, {lag_sql([1, 2, 3, 24, 168])} FROM t {W}")
def _(spark, sf):
    return windows.lag_features(v.hourly(spark, sf), [1, 2, 3, 24, 168], HOUR)


@query("rolling_mean_features", v.with_(v.T) + f"SELECT series_id, ts, value, {before_sql([3, 6, 12, 24])} FROM t")
def _(spark, sf):
    return windows.rolling_mean_features(v.hourly(spark, sf), [3, 6, 12, 24], HOUR)


@query("rolling_mean", v.with_(v.T) + f"SELECT series_id, ts, value, round(rm, 6) AS rolling_mean FROM (SELECT *, {strict_sql(12, 'rm')} FROM t)")
def _(spark, sf):
    return windows.rolling_mean(v.hourly(spark, sf), 12, HOUR)


@query("rolling_mean_min1", v.with_(v.T) + """
SELECT series_id, ts, value, round(avg(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 6) AS rolling_mean FROM t""")
def _(spark, sf):
    return windows.rolling_mean(v.hourly(spark, sf), 50, HOUR, min_periods=1)


@query("rolling_means", v.with_(v.T) + f"""
SELECT series_id, ts, value, round(a, 6) AS ma_7, round(b, 6) AS ma_14, round(c, 6) AS ma_30
FROM (SELECT *, {strict_sql(7, 'a')}, {strict_sql(14, 'b')}, {strict_sql(30, 'c')} FROM t)""")
def _(spark, sf):
    return windows.rolling_means(v.hourly(spark, sf), [7, 14, 30], HOUR)


@query("prefix_stats", v.with_(v.T) + """
SELECT series_id, ts, value, round(avg(value) OVER p, 11) AS prefix_mean, round(var_pop(value) OVER p, 4) AS prefix_var FROM t
WINDOW p AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", digits=11)
def _(spark, sf):
    # Means of cents end in a 5 at the sixth place too often to round there; a
    # running variance in the SQL engine loses more digits than the merge here.
    stats = windows.prefix_stats(v.hourly(spark, sf), HOUR, tile_rows=200)
    return stats.withColumn("prefix_var", F.round("prefix_var", 4))


@query("difference", v.with_(v.T) + f"""
SELECT series_id, ts, value, round(value - 2 * lag(value, 1) OVER w + lag(value, 2) OVER w, 6) AS diff FROM t {W}""")
def _(spark, sf):
    return windows.difference(v.hourly(spark, sf), HOUR, n=2)


@query("seasonal_difference", v.with_(v.T) + f""",
s AS (SELECT series_id, ts, value, value - lag(value, 24) OVER w AS sd FROM t {W})
SELECT series_id, ts, value, round(sd - lag(sd) OVER w, 6) AS diff FROM s {W}""".replace("\n,", ",", 1))
def _(spark, sf):
    return windows.difference(v.hourly(spark, sf), HOUR, n=1, seasonal=24)


LAGS, SIZES = windows.HOURLY_LAGS, windows.HOURLY_WINDOWS
HALF = """hh AS (SELECT event_type AS series_id, time_bucket(INTERVAL 30 MINUTE, ts) AS ts, round(sum(value), 6) AS value FROM events GROUP BY 1, 2),
hg AS (SELECT s.series_id, g.ts FROM (SELECT DISTINCT series_id FROM hh) s CROSS JOIN
  (SELECT unnest(generate_series((SELECT min(ts) FROM hh), (SELECT max(ts) FROM hh), INTERVAL 30 MINUTE)) AS ts) g),
t AS (SELECT hg.series_id, hg.ts, coalesce(hh.value, 0.0) AS value, row_number() OVER (PARTITION BY hg.series_id ORDER BY hg.ts) AS rn
  FROM hg LEFT JOIN hh USING (series_id, ts))"""


@query("feature_matrix_half_hour", v.with_(HALF) + f"""
SELECT * EXCLUDE (rn) FROM (SELECT series_id, ts, {lag_sql(windows.HALF_HOUR_LAGS)}, {before_sql(windows.HALF_HOUR_WINDOWS)}, hour(ts) AS hour, isodow(ts) - 1 AS dow, value AS y, rn
FROM t {W}) WHERE rn > 1008""")
def _(spark, sf):
    panel = regularize(v.type_events(spark, sf), HOUR // 2, span="panel", fill=0.0)
    panel = panel.withColumn("value", F.round("value", 6))
    return windows.feature_matrix(panel, HOUR // 2, lags=windows.HALF_HOUR_LAGS, windows=windows.HALF_HOUR_WINDOWS)


@query("feature_matrix", v.with_(v.T) + f"""
SELECT * EXCLUDE (rn) FROM (SELECT series_id, ts, {lag_sql(LAGS)}, {before_sql(SIZES)}, hour(ts) AS hour, isodow(ts) - 1 AS dow, value AS y, rn
FROM t {W}) WHERE rn > 24""")
def _(spark, sf):
    return windows.feature_matrix(v.hourly(spark, sf), HOUR, lags=LAGS, windows=SIZES)
