"""Back-testing queries."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.anomalies import HOLDOUT, holdout
from panelcast.catalog.forecasts import HOLT, OUT, SES, seasonal_sql
from panelcast.catalog.registry import query
from panelcast.catalog.rolling import strict_sql
from panelcast.functions.numeric import BOX_COX_LAMBDA
from panelcast.operators import evaluate, windows
from panelcast.operators.clean import regularize
from panelcast.operators.forecast import arima, pooled
from panelcast.operators.forecast.baseline import forecast_mean, forecast_naive
from panelcast.operators.forecast.structural import forecast_structural
from panelcast.plans.grid import DAY, HOUR, MONTH
from panelcast.session import shared_dir
from panelcast.sources import load_model, save_model

N = "k AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM m)"

FOLDS = """f AS (SELECT k.*, j AS fold, n // 6 AS size, n - (5 - j + 1) * (n // 6) AS st FROM k CROSS JOIN (SELECT unnest(generate_series(1, 5)) AS j)),
p AS (SELECT *, CASE WHEN rn - 1 < st THEN 'train' WHEN rn - 1 < st + size THEN 'test' END AS part FROM f)"""


@query("expanding_folds", v.with_(v.M, N, FOLDS) + "SELECT series_id, ts, value, fold, part FROM p WHERE part IS NOT NULL", digits=4)
def _(spark, sf):
    return evaluate.expanding_folds(v.monthly(spark, sf), 5)


def metric_sql(a: str = "actual", f: str = "forecast", digits: int = 4) -> str:
    e = f"({a} - {f})"
    return f"""count({e}) AS n, count({a}) - count({e}) AS n_missing, round(avg({e} * {e}), {-3 if digits == 2 else digits}) AS mse, round(avg(abs({e})), {digits}) AS mae,
  round(sqrt(avg({e} * {e})), {digits}) AS rmse, round(avg(abs({e} / nullif({a}, 0))) * 100, {digits}) AS mape, count({e} / nullif({a}, 0)) AS n_mape"""


def coarse_mse(df):
    """Squared order values are near 1e12, where a double holds no second decimal."""
    return df.withColumn("mse", F.round("mse", -3))


@query("expanding_cv", v.with_(v.M, N, FOLDS) + """,
tr AS (SELECT series_id, fold, avg(value) AS forecast FROM p WHERE part = 'train' GROUP BY 1, 2),
ev AS (SELECT p.series_id, p.fold, p.value AS actual, forecast FROM p JOIN tr USING (series_id, fold) WHERE part = 'test')
SELECT series_id, fold, """.replace("\n,", ",", 1) + metric_sql(digits=2) + " FROM ev GROUP BY 1, 2", digits=2)
def _(spark, sf):
    folds = evaluate.expanding_folds(v.monthly(spark, sf), 5)
    rows = evaluate.evaluate_folds(folds, forecast_mean, None, MONTH, model="mean")
    return coarse_mse(evaluate.metrics(rows, ["series_id", "fold"]))


ROLL = """o AS (SELECT a.series_id, a.rn AS t, a.ts AS origin_ts, h AS horizon, b.ts, b.value AS actual, a.n FROM k a
  CROSS JOIN (SELECT unnest(generate_series(1, 6)) AS h) JOIN k b ON b.series_id = a.series_id AND b.rn = a.rn + h WHERE a.rn >= 60 AND a.rn <= a.n - 6),
g AS (SELECT o.*, 'naive' AS model, m.value AS forecast FROM o JOIN m ON m.series_id = o.series_id AND m.rn = o.t
  UNION ALL SELECT o.*, 'snaive', m.value FROM o JOIN m ON m.series_id = o.series_id AND m.rn = o.t - 12 + 1 + (o.horizon - 1) % 12
  UNION ALL SELECT o.*, 'mean', mm.value FROM o JOIN (SELECT series_id, rn, avg(value) OVER (PARTITION BY series_id ORDER BY rn) AS value FROM m) mm
    ON mm.series_id = o.series_id AND mm.rn = o.t
  UNION ALL SELECT o.*, 'ses', s.lvl FROM o JOIN (SELECT *, row_number() OVER (PARTITION BY series_id, rn ORDER BY sse, alpha) AS r FROM ses) s
    ON s.series_id = o.series_id AND s.rn = o.t AND s.r = 1),
ev AS (SELECT series_id, model, origin_ts, horizon, ts, actual, forecast, actual - forecast AS error FROM g)"""


def rolling(spark, sf):
    panel = v.monthly(spark, sf)
    parts = [evaluate.rolling_origin(panel, m, MONTH) for m in ("naive", "snaive", "mean", "ses")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("rolling_origin", v.with_recursive(v.M, N, SES, ROLL) + """
SELECT series_id, model, origin_ts, horizon, ts, round(actual, 4) AS actual, round(forecast, 4) AS forecast, round(error, 4) AS error FROM ev""", digits=4)
def _(spark, sf):
    return rolling(spark, sf)


@query("horizon_metrics", v.with_recursive(v.M, N, SES, ROLL) + """
SELECT horizon, count(error) AS n, round(sqrt(avg(error * error)), 4) AS rmse, round(avg(abs(error)), 4) AS mae FROM ev WHERE model = 'naive' GROUP BY 1""", digits=4)
def _(spark, sf):
    return evaluate.metrics_by_horizon(evaluate.rolling_origin(v.monthly(spark, sf), "naive", MONTH))


@query("rolling_origin_hw_mul")
def _(spark, sf):
    return evaluate.rolling_origin(v.monthly(spark, sf), "mul", MONTH)


# The regression of each value on the one before, over all rows up to every origin, and its forecasts in closed form.
AR1 = """lg AS (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY rn) AS lv FROM k),
ft AS (SELECT a.series_id, a.rn, max(a.n) AS n, regr_slope(b.value, b.lv) AS phi, regr_intercept(b.value, b.lv) AS c, any_value(a.value) AS value, any_value(a.ts) AS ts
  FROM lg a JOIN lg b ON b.series_id = a.series_id AND b.rn <= a.rn GROUP BY 1, 2),
ah AS (SELECT ft.*, h, c * (1 - pow(phi, h)) / (1 - phi) + pow(phi, h) * value AS forecast FROM ft CROSS JOIN (SELECT unnest(generate_series(1, 60)) AS h))"""


@query("rolling_origin_ar1", v.with_(v.M, N, AR1) + """
SELECT ah.series_id, 'arima' AS model, ah.ts AS origin_ts, h AS horizon, k.ts, round(k.value, 2) AS actual, round(forecast, 2) AS forecast, round(k.value - forecast, 2) AS error
FROM ah JOIN k ON k.series_id = ah.series_id AND k.rn = ah.rn + h WHERE h <= 6 AND ah.rn >= 60 AND ah.rn <= ah.n - 6""", digits=2)
def _(spark, sf):
    return evaluate.rolling_origin(v.monthly(spark, sf), "arima", MONTH)


@query("rolling_origin_sarima", digits=2)
def _(spark, sf):
    return evaluate.rolling_origin(v.monthly(spark, sf), "sarima", MONTH, order=(1, 0, 0), seasonal=(1, 1, 0, 12))


@query("expanding_ar1", v.with_(v.M, N, AR1) + """
SELECT f.series_id, j AS fold, f.rn AS n_train, f.ts AS origin_ts, h AS horizon, k.ts, round(k.value, 2) AS actual, round(f.forecast, 2) AS forecast, 'arima' AS model,
  round(k.value - f.forecast, 2) AS error FROM (SELECT ah.*, unnest(generate_series(1, 5)) AS j FROM ah) f JOIN k ON k.series_id = f.series_id AND k.rn = f.rn + h
WHERE f.rn = f.n - (5 - j + 1) * (f.n // 6) AND h <= f.n // 6""", digits=2)
def _(spark, sf):
    return evaluate.expanding_autoregression(v.monthly(spark, sf), MONTH, 5)


@query("fold_status", v.with_(v.U, "c AS (SELECT series_id, count(*) AS n FROM u GROUP BY 1), f AS (SELECT *, unnest(generate_series(1, 5)) AS fold FROM c)") + """
SELECT series_id, fold, greatest(n - (6 - fold) * 14, 0) AS n_train, CAST(14 AS BIGINT) AS n_test, CASE WHEN n - (6 - fold) * 14 < 3 THEN 'too_short' ELSE 'ok' END AS status FROM f""")
def _(spark, sf):
    return evaluate.fold_status(v.user_events(spark, sf), 5, test_size=14, least=3)


# Errors of repeating the value of an hour ago, from a window of 60 hours on.
ONE = """ev AS (SELECT a.series_id, 'naive' AS model, a.ts AS origin_ts, 1 AS horizon, b.ts, b.value AS actual, a.value AS forecast,
  b.value - a.value AS error FROM t a JOIN t b ON b.series_id = a.series_id AND b.rn = a.rn + 1 WHERE a.rn >= 60)"""


@query("rolling_rmse", v.with_(v.T, ONE) + f"""
SELECT series_id, model, origin_ts, CAST(horizon AS BIGINT) AS horizon, ts, round(actual, 6) AS actual, round(forecast, 6) AS forecast,
  round(error, 6) AS error, round(sqrt(x), 6) AS rolling_rmse FROM (SELECT *, {strict_sql(12, 'x', 'error * error')} FROM ev)""")
def _(spark, sf):
    rows = evaluate.rolling_origin(v.hourly(spark, sf), "naive", HOUR, max_horizon=1)
    return windows.rolling_rmse(rows, HOUR, 12)


@query("rolling_mape", v.with_(v.T, ONE) + f"""
SELECT series_id, model, origin_ts, CAST(horizon AS BIGINT) AS horizon, ts, round(actual, 6) AS actual, round(forecast, 6) AS forecast,
  round(error, 6) AS error, round(x, 6) AS rolling_mape FROM (SELECT *, {strict_sql(12, 'x', 'abs(error / nullif(actual, 0))')} FROM ev)""")
def _(spark, sf):
    rows = evaluate.rolling_origin(v.hourly(spark, sf), "naive", HOUR, max_horizon=1)
    return windows.rolling_mape(rows, HOUR, 12)


@query("cutoff_cv", v.with_(v.M) + """,
sp AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM m GROUP BY 1),
cu AS (SELECT series_id, last_day(d)::TIMESTAMP AS cutoff FROM (SELECT series_id, hi, unnest(generate_series(date_trunc('month', lo + INTERVAL 2 YEAR)::TIMESTAMP,
  (hi - INTERVAL 1 YEAR)::TIMESTAMP, INTERVAL 12 MONTH)) AS d FROM sp) WHERE last_day(d) <= (hi - INTERVAL 1 YEAR)::DATE),
ev AS (SELECT m.series_id, m.value AS actual, (SELECT arg_max(b.value, b.ts) FROM m b WHERE b.series_id = cu.series_id AND b.ts <= cu.cutoff) AS forecast
  FROM cu JOIN m ON m.series_id = cu.series_id AND m.ts > cutoff AND m.ts <= cutoff + INTERVAL 365 DAY)
SELECT """.replace("\n,", ",", 1) + metric_sql(digits=2) + " FROM ev", digits=2)
def _(spark, sf):
    rows = evaluate.cutoff_cv(v.monthly(spark, sf), forecast_naive, None, MONTH, model="naive")
    return coarse_mse(evaluate.metrics(rows))


@query("cutoff_cv_structural", digits=2)
def _(spark, sf):
    rows = evaluate.cutoff_cv(v.monthly(spark, sf), forecast_structural, None, MONTH, model="structural")
    return coarse_mse(evaluate.metrics(rows, ["series_id"]))


@query("grid_structural", digits=2)
def _(spark, sf):
    return coarse_mse(evaluate.grid_search_structural(v.monthly(spark, sf), MONTH)[1])


@query("forecast_structural_tuned", digits=2)
def _(spark, sf):
    return evaluate.forecast_tuned_structural(v.monthly(spark, sf), 12, MONTH)


COMPARE = """c AS (SELECT k.*, j AS fold, n - (3 - j + 1) * 12 AS st FROM k CROSS JOIN (SELECT unnest(generate_series(1, 3)) AS j)),
te AS (SELECT * FROM c WHERE rn > st AND rn <= st + 12),
ev AS (SELECT te.series_id, 'mean' AS model, te.fold, te.value AS actual, x.f AS forecast FROM te JOIN (SELECT series_id, fold, avg(value) AS f FROM c WHERE rn <= st GROUP BY 1, 2) x USING (series_id, fold)
  UNION ALL SELECT te.series_id, 'naive', te.fold, te.value, m.value FROM te JOIN m ON m.series_id = te.series_id AND m.rn = te.st
  UNION ALL SELECT te.series_id, 'snaive', te.fold, te.value, m.value FROM te JOIN m ON m.series_id = te.series_id AND m.rn = te.rn - 12
  UNION ALL SELECT te.series_id, 'ses', te.fold, te.value, s.lvl FROM te JOIN (SELECT *, row_number() OVER (PARTITION BY series_id, rn ORDER BY sse, alpha) AS r FROM ses) s
    ON s.series_id = te.series_id AND s.rn = te.st AND s.r = 1
  UNION ALL SELECT te.series_id, 'holt', te.fold, te.value, s.lvl + (te.rn - te.st) * s.tr FROM te JOIN (SELECT *, row_number() OVER (PARTITION BY series_id, rn ORDER BY sse, alpha, beta) AS r FROM holt) s
    ON s.series_id = te.series_id AND s.rn = te.st AND s.r = 1),
pf AS (SELECT series_id, model, fold, avg(pow(actual - forecast, 2)) AS mse, avg(abs(actual - forecast)) AS mae, sqrt(avg(pow(actual - forecast, 2))) AS rmse,
  avg(abs((actual - forecast) / nullif(actual, 0))) * 100 AS mape FROM ev GROUP BY 1, 2, 3)"""


BOARD = ("mean", "naive", "snaive", "ses", "holt")
HZ = "hz AS (SELECT 1 AS h)"


@query("leaderboard", v.with_recursive(v.M, HZ, N, SES, HOLT, COMPARE) + """
SELECT model, n_fits, CAST(0 AS BIGINT) AS n_missing, round(mse, -3) AS mse, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(mape, 2) AS mape, row_number() OVER (ORDER BY mae, model) AS rank
FROM (SELECT model, count(*) AS n_fits, avg(mse) AS mse, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape FROM pf GROUP BY 1)""", digits=2)
def _(spark, sf):
    return coarse_mse(evaluate.leaderboard(evaluate.compare_models(v.monthly(spark, sf), MONTH, models=BOARD)))


@query("leaderboard_all", digits=2)
def _(spark, sf):
    return coarse_mse(evaluate.leaderboard(evaluate.compare_models(v.monthly(spark, sf), MONTH)))


# Models per series and models over all series on the same rows: the last day of the hourly totals.
TOGETHER = ["mean", "naive", "snaive", "structural", *pooled.MODELS]


@query("leaderboard_pooled", digits=2)
def _(spark, sf):
    return coarse_mse(evaluate.leaderboard(evaluate.compare_models(v.hourly(spark, sf), HOUR, folds=1, horizon=24, models=TOGETHER)))


# Days of single users: many gaps, short series and, once filled, zeros.
USER_DAYS = """ud AS (SELECT series_id, date_trunc('day', ts) AS ts, sum(value) AS value FROM u GROUP BY 1, 2),
sp AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi, count(*) AS known, date_diff('day', min(ts), max(ts)) + 1 AS steps, min(value) AS least FROM ud GROUP BY 1)"""


@query("forecast_status", v.with_(v.U, USER_DAYS) + """
SELECT series_id, model, known AS n, CASE WHEN (CASE WHEN whole THEN steps ELSE known END) < need THEN 'too_short' WHEN whole AND known < steps THEN 'has_gaps'
  WHEN positive AND least <= 0 THEN 'not_positive' ELSE 'ok' END AS status
FROM sp CROSS JOIN (VALUES ('mean', 1, false, false), ('naive', 1, false, false), ('snaive', 1, false, false), ('ses', 2, true, false),
  ('holt', 3, true, false), ('hw_add', 24, true, false), ('hw_mul', 24, true, true), ('arima', 15, true, false), ('sarima', 50, true, false),
  ('structural', 1, false, false)) AS r(model, need, whole, positive)""")
def _(spark, sf):
    return evaluate.forecast_status(regularize(v.user_events(spark, sf), DAY))


@query("best_model", v.with_recursive(v.M, HZ, N, SES, HOLT, COMPARE) + """
SELECT series_id, model, round(mae, 4) AS mae FROM (SELECT series_id, model, avg(abs(actual - forecast)) AS mae,
  row_number() OVER (PARTITION BY series_id ORDER BY avg(abs(actual - forecast)), model) AS r FROM ev GROUP BY 1, 2) WHERE r = 1""", digits=4)
def _(spark, sf):
    return evaluate.best_model_per_series(evaluate.compare_models(v.monthly(spark, sf), MONTH, models=BOARD))


@query("segment_error", v.with_(v.T, ONE) + "SELECT CAST(isodow(ts) - 1 AS BIGINT) AS segment, " + metric_sql() + " FROM ev GROUP BY 1", digits=4)
def _(spark, sf):
    return evaluate.error_by_segment(evaluate.rolling_origin(v.hourly(spark, sf), "naive", HOUR, max_horizon=1), "dow")


@query("load_error", v.with_(v.T, ONE) + """,
q AS (SELECT series_id, quantile_cont(actual, 0.25) AS a, quantile_cont(actual, 0.5) AS b, quantile_cont(actual, 0.75) AS c FROM ev GROUP BY 1),
r AS (SELECT ev.*, 1 + (actual > a)::BIGINT + (actual > b)::BIGINT + (actual > c)::BIGINT AS regime FROM ev JOIN q USING (series_id))
SELECT regime, """.replace("\n,", ",", 1) + metric_sql() + " FROM r GROUP BY 1", digits=4)
def _(spark, sf):
    return evaluate.error_by_load(evaluate.rolling_origin(v.hourly(spark, sf), "naive", HOUR, max_horizon=1))


@query("bias_coverage", v.with_(v.T, HOLDOUT) + """
SELECT series_id, count(yhat) AS n, round(avg(yhat - value), 6) AS bias, round(avg((value BETWEEN least(lower, upper) AND greatest(lower, upper))::INT), 6) AS coverage FROM rs GROUP BY 1""")
def _(spark, sf):
    return evaluate.bias_and_coverage(evaluate.attach_forecast(*holdout(spark, sf)))


@query("attach_forecast", v.with_(v.T, HOLDOUT) + """
SELECT t.series_id, t.ts, round(t.value, 6) AS value, round(yhat, 6) AS yhat, round(lower, 6) AS lower, round(upper, 6) AS upper
FROM t LEFT JOIN rs ON rs.series_id = t.series_id AND rs.ts = t.ts""")
def _(spark, sf):
    return evaluate.attach_forecast(v.hourly(spark, sf), holdout(spark, sf)[1])


@query("metrics_filled", v.with_(v.T_GAPS) + """,
fl AS (SELECT series_id, ts, coalesce(value, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS actual FROM tn),
mm AS (SELECT series_id, round(avg(value), 6) AS forecast FROM tn GROUP BY 1)
SELECT series_id, """.replace("\n,", ",", 1) + metric_sql() + " FROM fl JOIN mm USING (series_id) GROUP BY 1", digits=4)
def _(spark, sf):
    panel = v.hourly(spark, sf, fill=None)
    mean = panel.groupBy("series_id").agg(F.round(F.avg("value"), 6).alias("_m"))
    flat = panel.join(mean, "series_id").select("series_id", "ts", F.col("_m").alias("value"))
    return evaluate.metrics_filled(panel, flat, HOUR)


@query("rmse_per_series", v.with_(v.M) + """,
x AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM m)
SELECT a.series_id, round(sqrt(avg(pow(a.value - b.value, 2))), 4) AS rmse FROM x a JOIN x b ON a.series_id = b.series_id AND b.rn = a.n - 12
WHERE a.rn > a.n - 12 GROUP BY 1""".replace("\n,", ",", 1), digits=4)
def _(spark, sf):
    return evaluate.rmse_per_series(evaluate.holdout_predict(v.monthly(spark, sf), "naive", MONTH, n_test=12))


TRAIN = v.M.replace("m AS (SELECT mg.", "ma AS (SELECT mg.") + """,
m AS (SELECT * FROM ma WHERE rn <= (SELECT max(rn) FROM ma) - 12)"""


@query("holdout_predict", v.with_recursive(TRAIN, seasonal_sql("add", 12)) + """
SELECT fc.series_id, 'hw_add' AS model, origin_ts, h AS horizon, ma.ts, round(ma.value, 4) AS actual, round(yhat, 4) AS forecast, round(ma.value - yhat, 4) AS error
FROM fc JOIN ma ON ma.series_id = fc.series_id AND ma.rn = (SELECT max(rn) FROM m) + h""", digits=4)
def _(spark, sf):
    rows = evaluate.holdout_predict(v.monthly(spark, sf), "hw_add", MONTH, n_test=12)
    return rows.select("series_id", "model", "origin_ts", "horizon", "ts", "actual", "forecast", "error")


@query("future_predict", v.with_recursive(v.M, seasonal_sql("mul", 24)) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return evaluate.future_predict(v.monthly(spark, sf), "hw_mul", MONTH, horizon=24)


GRID_SES = v.with_recursive(v.M, N, SES) + """,
sc AS (SELECT s.series_id, s.alpha, sqrt(avg(pow(k.value - s.lvl, 2))) AS rmse FROM ses s JOIN k ON k.series_id = s.series_id AND s.rn = k.n - 12 AND k.rn > k.n - 12 GROUP BY 1, 2)
SELECT series_id, round(rmse, 4) AS rmse, alpha, 0.0::DOUBLE AS beta, 0.0::DOUBLE AS gamma FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY rmse, alpha) AS r FROM sc) WHERE r = 1""".replace("\n,", ",", 1)


@query("grid_ses", GRID_SES, digits=4)
def _(spark, sf):
    return evaluate.grid_search_smoothing(v.monthly(spark, sf), "ses", n_test=12)[0]


@query("model_round_trip", GRID_SES, digits=4)
def _(spark, sf):
    path = shared_dir(spark, "model")
    save_model(evaluate.grid_search_smoothing(v.monthly(spark, sf), "ses", n_test=12)[0], path)
    return load_model(spark, path)


@query("grid_holt", v.with_recursive(v.M, "hz AS (SELECT 1 AS h)", N, HOLT) + """
SELECT s.series_id, alpha, beta, 0.0::DOUBLE AS gamma, round(sqrt(avg(pow(k.value - s.lvl - (k.rn - s.rn) * s.tr, 2))), 4) AS rmse
FROM holt s JOIN k ON k.series_id = s.series_id AND s.rn = k.n - 12 AND k.rn > k.n - 12 GROUP BY 1, 2, 3""", digits=4)
def _(spark, sf):
    return evaluate.grid_search_smoothing(v.monthly(spark, sf), "holt", n_test=12)[1]


def orders():
    plain = [((p, d, q), arima.FLAT) for p in range(3) for d in range(3) for q in range(3)]
    binary = list(product((0, 1), repeat=6))
    seasonal = [((p, d, q), (sp, sd, sq, 12)) for p, d, q, sp, sd, sq in binary]
    return plain + seasonal


@query("order_search")
def _(spark, sf):
    return arima.order_search(v.monthly(spark, sf), 12, orders())


@query("forecast_best_order", digits=2)
def _(spark, sf):
    positive = v.monthly(spark, sf).withColumn("value", F.col("value") + 1)
    return arima.forecast_best_order(positive, 12, MONTH, orders=orders(), box_cox=BOX_COX_LAMBDA)
