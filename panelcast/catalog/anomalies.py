"""Anomaly queries on the hourly panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.registry import query
from panelcast.catalog.rolling import strict_sql
from panelcast.operators import anomaly
from panelcast.operators.forecast.baseline import forecast_snaive
from panelcast.operators.forecast.contract import to_contract
from panelcast.plans.grid import HOUR

IQR = """q AS (SELECT series_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM t GROUP BY 1),
iqr AS (SELECT series_id, ts, value, 'iqr' AS method, greatest((q1 - 1.5 * (q3 - q1)) - value, value - (q3 + 1.5 * (q3 - q1))) / nullif(q3 - q1, 0) AS score,
  q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM t JOIN q USING (series_id)
  WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))"""

Z = """zs AS (SELECT *, avg(value) OVER (PARTITION BY series_id) AS mu, stddev_pop(value) OVER (PARTITION BY series_id) AS sd FROM t),
zscore AS (SELECT series_id, ts, value, 'zscore' AS method, (value - mu) / nullif(sd, 0) AS score, mu - 3 * sd AS lower, mu + 3 * sd AS upper
  FROM zs WHERE abs((value - mu) / nullif(sd, 0)) > 3)"""


def decompose_sql(period: int, source: str = "t", out: str = "dc") -> str:
    """Classical additive decomposition of an even period."""
    half = period // 2
    frame = f"OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    w = "OVER (PARTITION BY series_id ORDER BY ts)"
    return f"""{out}_a AS (SELECT *, CASE WHEN count(value) {frame} = {2 * half + 1} THEN
  (sum(value) {frame} - (lag(value, {half}) {w} + lead(value, {half}) {w}) / 2) / {period} END AS trend FROM {source}),
{out}_b AS (SELECT series_id, rn % {period} AS ph, avg(value - trend) AS s FROM {out}_a GROUP BY 1, 2),
{out}_c AS (SELECT series_id, ph, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM {out}_b),
{out} AS (SELECT a.series_id, a.ts, a.value, a.rn, a.trend, c.seasonal, a.value - a.trend - c.seasonal AS resid
  FROM {out}_a a JOIN {out}_c c ON a.series_id = c.series_id AND a.rn % {period} = c.ph)"""


DEC = decompose_sql(50) + """,
ds AS (SELECT *, stddev_samp(resid) OVER (PARTITION BY series_id) AS sd FROM dc),
decomp AS (SELECT series_id, ts, value, 'decompose' AS method, resid / sd AS score, trend + seasonal - 2 * sd AS lower,
  trend + seasonal + 2 * sd AS upper FROM ds WHERE abs(resid) > 2 * sd)"""

FOUND = "series_id, ts, round(value, 6) AS value, method, round(score, 6) AS score, round(lower, 6) AS lower, round(upper, 6) AS upper"


@query("outliers_iqr", v.with_(v.T, IQR) + f"SELECT {FOUND} FROM iqr")
def _(spark, sf):
    return anomaly.outliers_iqr(v.hourly(spark, sf))


@query("outliers_zscore", v.with_(v.T, Z) + f"SELECT {FOUND} FROM zscore")
def _(spark, sf):
    return anomaly.outliers_zscore(v.hourly(spark, sf))


@query("outliers_zscore_raw", v.with_(v.U, Z.replace("FROM t)", "FROM u)")) + f"SELECT {FOUND} FROM zscore")
def _(spark, sf):
    return anomaly.outliers_zscore(v.user_events(spark, sf))


@query("outliers_decompose", v.with_(v.T, DEC) + f"SELECT {FOUND} FROM decomp")
def _(spark, sf):
    return anomaly.outliers_decompose(v.hourly(spark, sf), HOUR)


@query("outliers_model")
def _(spark, sf):
    return anomaly.outliers_model(v.hourly(spark, sf))


AR1 = """x AS (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM t),
c AS (SELECT series_id, regr_slope(value, p) AS b, regr_intercept(value, p) AS a FROM x GROUP BY 1),
e AS (SELECT series_id, ts, value, value - a - b * p AS resid FROM x JOIN c USING (series_id) WHERE p IS NOT NULL),
s AS (SELECT *, avg(resid) OVER (PARTITION BY series_id) AS mu, stddev_pop(resid) OVER (PARTITION BY series_id) AS sd FROM e)"""


@query("outliers_ar1", v.with_(v.T, AR1) + """
SELECT series_id, ts, value, 'model' AS method, round((resid - mu) / sd, 6) AS score,
  round(value - resid + mu - 3 * sd, 6) AS lower, round(value - resid + mu + 3 * sd, 6) AS upper FROM s WHERE abs((resid - mu) / sd) > 3""")
def _(spark, sf):
    return anomaly.outliers_model(v.hourly(spark, sf), order=(1, 0, 0))


BAND = f"""ma AS (SELECT *, {strict_sql(24, 'ma')} FROM t),
wd AS (SELECT series_id, avg(abs(value - ma)) + 1.96 * stddev_pop(value - ma) AS width FROM ma WHERE rn > 24 GROUP BY 1)"""


@query("ma_band", v.with_(v.T, BAND) + """
SELECT series_id, ts, value, round(ma, 6) AS ma, round(ma - width, 6) AS lower, round(ma + width, 6) AS upper,
  ma IS NOT NULL AND (value < ma - width OR value > ma + width) AS is_anomaly FROM ma JOIN wd USING (series_id)""")
def _(spark, sf):
    return anomaly.moving_average_band(v.hourly(spark, sf), 24, HOUR)


ALL = f"""{IQR}, {Z}, {DEC}, {BAND},
band AS (SELECT series_id, ts, value, 'band' AS method, (value - ma) / width AS score, ma - width AS lower, ma + width AS upper
  FROM ma JOIN wd USING (series_id) WHERE value < ma - width OR value > ma + width),
{AR1},
model AS (SELECT series_id, ts, value, 'model' AS method, (resid - mu) / sd AS score, value - resid + mu - 3 * sd AS lower, value - resid + mu + 3 * sd AS upper
  FROM s WHERE abs((resid - mu) / sd) > 3),
found AS (SELECT * FROM iqr UNION ALL SELECT * FROM zscore UNION ALL SELECT * FROM decomp UNION ALL SELECT * FROM band UNION ALL SELECT * FROM model)"""
METHODS = ["iqr", "zscore", "decompose", "model"]


def _detect(spark, sf):
    panel = v.hourly(spark, sf)
    found = anomaly.detect_all(panel, HOUR, period=50, methods=METHODS, order=(1, 0, 0))
    return found.unionByName(anomaly.outliers_band(panel, 24, HOUR))


@query("detect_all", v.with_(v.T, ALL) + f"SELECT {FOUND} FROM found")
def _(spark, sf):
    return _detect(spark, sf)


@query("anomaly_counts", v.with_(v.T, ALL) + "SELECT method, count(*) AS n_anomalies FROM found GROUP BY 1")
def _(spark, sf):
    return anomaly.count_by_method(_detect(spark, sf))


# The last five days against a seasonal naive forecast made from the days before.
HOLDOUT = """k AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n, lag(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS prev FROM t),
tr AS (SELECT * FROM k WHERE rn <= n - 120),
sq AS (SELECT series_id, quantile_cont(value - prev, 0.1) AS lo, quantile_cont(value - prev, 0.9) AS hi FROM tr GROUP BY 1),
rs AS (SELECT k.series_id, k.ts, k.value, b.value AS yhat, b.value + lo * sqrt(floor((k.rn - (k.n - 120) - 1) / 24) + 1) AS lower,
  b.value + hi * sqrt(floor((k.rn - (k.n - 120) - 1) / 24) + 1) AS upper, k.value - b.value AS resid, k.rn
  FROM k JOIN k b ON k.series_id = b.series_id AND b.rn = k.n - 120 - 24 + 1 + ((k.rn - (k.n - 120) - 1) % 24)
  JOIN sq ON sq.series_id = k.series_id WHERE k.rn > k.n - 120)"""


def holdout(spark, sf):
    from panelcast.operators.clean import split_last

    parts = split_last(v.hourly(spark, sf), 120, step=HOUR)
    train = parts.where("part = 'train'").drop("part")
    forecast = to_contract(forecast_snaive(train, 120, HOUR, season=24), "snaive")
    return parts.where("part = 'test'").drop("part"), forecast


def holdout_residuals(spark, sf):
    return anomaly.with_residuals(*holdout(spark, sf))


@query("residual_anomalies", v.with_(v.T, HOLDOUT) + f"""
SELECT {FOUND} FROM (SELECT series_id, ts, value, 'residual' AS method, (resid - avg(resid) OVER s) / nullif(stddev_pop(resid) OVER s, 0) AS score,
  lower, upper FROM rs WINDOW s AS (PARTITION BY series_id)) WHERE value < lower OR value > upper OR abs(score) > 2""")
def _(spark, sf):
    return anomaly.residual_anomalies(*holdout(spark, sf), k=2.0)


@query("persistent_residuals", v.with_(v.T, HOLDOUT) + """,
sg AS (SELECT *, sign(resid) AS sg, row_number() OVER (PARTITION BY series_id ORDER BY ts)
  - row_number() OVER (PARTITION BY series_id, sign(resid) ORDER BY ts) AS grp FROM rs)
SELECT series_id, min(ts) AS start_ts, max(ts) + INTERVAL 1 HOUR AS end_ts, count(*) AS n_steps, CAST(sg AS BIGINT) AS direction,
  round(avg(resid), 6) AS mean_resid FROM sg WHERE sg <> 0 GROUP BY series_id, sg, grp HAVING count(*) >= 3""".replace("\n,", ",", 1))
def _(spark, sf):
    return anomaly.persistent_residuals(holdout_residuals(spark, sf), HOUR, min_run=3)


@query("residual_drift", v.with_(v.T, HOLDOUT) + """,
f AS (SELECT *, ts > max(ts) OVER (PARTITION BY series_id) - INTERVAL 48 HOUR AS rec FROM rs),
mm AS (SELECT series_id, count(*) FILTER (rec) AS n_recent, count(*) FILTER (NOT rec) AS n_earlier, avg(resid) FILTER (rec) AS mean_recent,
  avg(resid) FILTER (NOT rec) AS mean_earlier, stddev_samp(resid) FILTER (rec) AS std_recent, stddev_samp(resid) FILTER (NOT rec) AS std_earlier
  FROM f GROUP BY 1),
ks AS (SELECT series_id, max(abs(a / n_recent - b / n_earlier)) AS ks FROM (
  SELECT series_id, resid, count(*) FILTER (rec) OVER (PARTITION BY series_id ORDER BY resid) AS a,
  count(*) FILTER (NOT rec) OVER (PARTITION BY series_id ORDER BY resid) AS b FROM f) JOIN mm USING (series_id) GROUP BY 1)
SELECT series_id, n_recent, n_earlier, round(mean_recent, 6) AS mean_recent, round(mean_earlier, 6) AS mean_earlier,
  round(std_recent, 6) AS std_recent, round(std_earlier, 6) AS std_earlier, round(std_recent / std_earlier, 6) AS std_ratio, round(ks, 6) AS ks
FROM mm JOIN ks USING (series_id)""".replace("\n,", ",", 1))
def _(spark, sf):
    return anomaly.residual_drift(holdout_residuals(spark, sf), HOUR, window=48)


RAMPS = """rp AS (SELECT a.series_id, a.ts, a.value - b.value AS ar, a.yhat - b.yhat AS fr FROM {0} a JOIN {0} b
  ON b.series_id = a.series_id AND b.ts = a.ts - INTERVAL 1 HOUR)
SELECT series_id, ts, round(ar, 6) AS actual_ramp, round(fr, 6) AS forecast_ramp FROM rp WHERE abs(ar - fr) > 100"""


@query("unexpected_ramps", v.with_(v.T, HOLDOUT, RAMPS.format("rs")))
def _(spark, sf):
    return anomaly.unexpected_ramps(holdout_residuals(spark, sf), HOUR, k=100.0)


# Hours without any event are left out: no ramp may lead over such a gap.
@query("unexpected_ramps_gaps", v.with_(v.T, HOLDOUT, "rg AS (SELECT rs.* FROM rs JOIN th USING (series_id, ts))", RAMPS.format("rg").replace("> 100", "> 20")))
def _(spark, sf):
    seen = v.hourly(spark, sf, fill=None).where("value IS NOT NULL").select("series_id", "ts")
    return anomaly.unexpected_ramps(holdout_residuals(spark, sf).join(seen, ["series_id", "ts"]), HOUR, k=20.0)


@query("outages", v.with_(v.T, HOLDOUT) + """,
g AS (SELECT *, abs(value) < 20 AND yhat > 40 AS flag FROM rs),
i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - row_number() OVER (PARTITION BY series_id, flag ORDER BY ts) AS grp FROM g)
SELECT series_id, min(ts) AS start_ts, max(ts) + INTERVAL 1 HOUR AS end_ts, count(*) AS n_steps, round(avg(value), 6) AS mean_value
FROM i WHERE flag GROUP BY series_id, grp""".replace("\n,", ",", 1))
def _(spark, sf):
    return anomaly.outages(holdout_residuals(spark, sf), HOUR, eps=20.0, k=40.0)


@query("stuck_sensor", v.with_(v.D) + """,
i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - row_number() OVER (PARTITION BY series_id, value ORDER BY ts) AS grp FROM d)
SELECT series_id, min(ts) AS start_ts, max(ts) + INTERVAL 1 DAY AS end_ts, count(*) AS n_steps, round(value, 6) AS value
FROM i GROUP BY series_id, value, grp HAVING count(*) >= 3""".replace("\n,", ",", 1))
def _(spark, sf):
    from panelcast.plans.grid import DAY

    return anomaly.stuck_sensor(v.daily_orders(spark, sf), DAY, min_run=3)
