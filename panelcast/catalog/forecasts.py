"""Forecast queries: monthly and hourly panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.registry import query
from panelcast.operators.clean import last_window, split_fraction
from panelcast.operators.forecast import arima, baseline, forest, quantile, smoothing, structural, var
from panelcast.operators.forecast.contract import check_contract, to_contract
from panelcast.operators.windows import HOURLY_LAGS, HOURLY_WINDOWS, feature_matrix
from panelcast.plans.grid import DAY, HOUR, MONTH

H12 = "hz AS (SELECT unnest(generate_series(1, 12)) AS h)"
OUT = "series_id, h, CAST(origin_ts + to_months(CAST(h AS INTEGER)) AS TIMESTAMP) AS ts, round(yhat, 4) AS yhat, round(lower, 4) AS lower, round(upper, 4) AS upper, origin_ts"

MEAN = """fc AS (SELECT series_id, h, y AS yhat, lo AS lower, hi AS upper, origin_ts FROM (SELECT series_id, avg(value) AS y,
  quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi, max(ts) AS origin_ts FROM m GROUP BY 1) CROSS JOIN hz)"""

NAIVE = """x AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS e FROM m),
fc AS (SELECT series_id, h, y AS yhat, y + lo * sqrt(h) AS lower, y + hi * sqrt(h) AS upper, origin_ts FROM (SELECT series_id,
  arg_max(value, ts) AS y, quantile_cont(e, 0.1) AS lo, quantile_cont(e, 0.9) AS hi, max(ts) AS origin_ts FROM x GROUP BY 1) CROSS JOIN hz)"""

SNAIVE = """x AS (SELECT *, value - lag(value, 7) OVER (PARTITION BY series_id ORDER BY ts) AS e, count(*) OVER (PARTITION BY series_id) AS n FROM m),
q AS (SELECT series_id, max(n) AS n, max(ts) AS origin_ts, quantile_cont(e, 0.1) AS lo, quantile_cont(e, 0.9) AS hi FROM x GROUP BY 1),
fc AS (SELECT q.series_id, h, m.value AS yhat, m.value + lo * sqrt(floor((h - 1) / 7) + 1) AS lower,
  m.value + hi * sqrt(floor((h - 1) / 7) + 1) AS upper, origin_ts
  FROM q CROSS JOIN hz JOIN m ON m.series_id = q.series_id AND m.rn = q.n - 7 + 1 + (h - 1) % 7)"""

SES = """al AS (SELECT round(0.05 * i, 2)::DOUBLE AS alpha FROM (SELECT unnest(generate_series(1, 19)) AS i)),
ses AS (SELECT series_id, alpha, rn, value AS lvl, 0.0::DOUBLE AS sse FROM m CROSS JOIN al WHERE rn = 1
  UNION ALL SELECT s.series_id, s.alpha, m.rn, s.alpha * m.value + (1 - s.alpha) * s.lvl, s.sse + (m.value - s.lvl) * (m.value - s.lvl)
  FROM ses s JOIN m ON m.series_id = s.series_id AND m.rn = s.rn + 1)"""

SES_FC = SES + """,
fin AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY sse, alpha) AS r FROM ses
  WHERE rn = (SELECT max(rn) FROM m)),
res AS (SELECT m.series_id, quantile_cont(m.value - s.lvl, 0.1) AS lo, quantile_cont(m.value - s.lvl, 0.9) AS hi, max(m.ts) AS origin_ts
  FROM fin JOIN ses s ON s.series_id = fin.series_id AND s.alpha = fin.alpha JOIN m ON m.series_id = s.series_id AND m.rn = s.rn + 1
  WHERE fin.r = 1 GROUP BY 1),
fc AS (SELECT fin.series_id, h, lvl AS yhat, lvl + lo AS lower, lvl + hi AS upper, origin_ts FROM fin JOIN res USING (series_id) CROSS JOIN hz WHERE r = 1)"""

HOLT = """ab AS (SELECT round(0.1 * i, 1)::DOUBLE AS alpha, round(0.1 * j, 1)::DOUBLE AS beta
  FROM (SELECT unnest(generate_series(1, 9)) AS i) CROSS JOIN (SELECT unnest(generate_series(1, 9)) AS j)),
holt AS (SELECT a.series_id, alpha, beta, a.rn, a.value AS lvl, b.value - a.value AS tr, 0.0::DOUBLE AS sse
  FROM m a JOIN m b ON a.series_id = b.series_id AND a.rn = 1 AND b.rn = 2 CROSS JOIN ab
  UNION ALL SELECT s.series_id, s.alpha, s.beta, m.rn, s.alpha * m.value + (1 - s.alpha) * (s.lvl + s.tr),
  s.beta * (s.alpha * m.value + (1 - s.alpha) * (s.lvl + s.tr) - s.lvl) + (1 - s.beta) * s.tr,
  s.sse + pow(m.value - s.lvl - s.tr, 2) FROM holt s JOIN m ON m.series_id = s.series_id AND m.rn = s.rn + 1),
fin AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY sse, alpha, beta) AS r FROM holt WHERE rn = (SELECT max(rn) FROM m)),
res AS (SELECT m.series_id, quantile_cont(m.value - s.lvl - s.tr, 0.1) AS lo, quantile_cont(m.value - s.lvl - s.tr, 0.9) AS hi, max(m.ts) AS origin_ts
  FROM fin JOIN holt s ON s.series_id = fin.series_id AND s.alpha = fin.alpha AND s.beta = fin.beta
  JOIN m ON m.series_id = s.series_id AND m.rn = s.rn + 1 WHERE fin.r = 1 GROUP BY 1),
fc AS (SELECT fin.series_id, h, lvl + h * tr AS yhat, lvl + h * tr + lo AS lower, lvl + h * tr + hi AS upper, origin_ts
  FROM fin JOIN res USING (series_id) CROSS JOIN hz WHERE r = 1)"""


def seasonal_sql(kind: str, horizon: int) -> str:
    """Seasonal smoothing of period 12: coarse grid, one refinement, forecasts and error quantiles."""
    add = kind == "add"
    i = "(h.rn % 12 + 1)"
    guess = f"(h.l + h.t + h.s[{i}])" if add else f"((h.l + h.t) * h.s[{i}])"
    level = f"(h.a * (m.value {'-' if add else '/'} h.s[{i}]) + (1 - h.a) * (h.l + h.t))"
    fresh = "(m.value - h.l - h.t)" if add else "(m.value / (h.l + h.t))"

    def walk(name: str, grid: str) -> str:
        return f"""{name} AS (SELECT i0.series_id, a, b, g, 12::BIGINT AS rn, l, t, s, 0.0::DOUBLE AS sse FROM {grid}
  UNION ALL SELECT h.series_id, h.a, h.b, h.g, m.rn, {level}, h.b * ({level} - h.l) + (1 - h.b) * h.t,
  list_transform(h.s, lambda x, j: CASE WHEN j = {i} THEN h.g * {fresh} + (1 - h.g) * x ELSE x END),
  h.sse + pow(m.value - {guess}, 2) FROM {name} h JOIN m ON m.series_id = h.series_id AND m.rn = h.rn + 1)"""

    def winner(name: str, walked: str) -> str:
        return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY sse, a, b, g) AS r
  FROM {walked} WHERE rn = (SELECT max(rn) FROM m)) WHERE r = 1)"""

    def around(c: str) -> str:
        return f"least(greatest(round({c} + {c}d, 2), 0.0), 1.0)::DOUBLE AS {c}"

    offsets = "(SELECT unnest([-0.1, -0.05, 0.0, 0.05, 0.1])::DOUBLE AS {}d)"
    values = "(SELECT unnest([0.1, 0.3, 0.5, 0.7, 0.9])::DOUBLE AS {})"
    season = "list(value - l ORDER BY rn)" if add else "list(value / l ORDER BY rn)"
    place = "s[(rn + h - 1) % 12 + 1]"
    positive = "" if add else " AND min(value) > 0"
    path = f"l + h * t + {place}" if add else f"(l + h * t) * {place}"
    return f"""hz AS (SELECT unnest(generate_series(1, {horizon})) AS h),
lv AS (SELECT series_id, avg(value) FILTER (rn <= 12) AS l, avg(value) FILTER (rn > 12 AND rn <= 24) AS l2 FROM m GROUP BY 1 HAVING count(*) >= 24{positive}),
i0 AS (SELECT m.series_id, max(l) AS l, max((l2 - l) / 12) AS t, {season} AS s FROM m JOIN lv USING (series_id) WHERE rn <= 12 GROUP BY 1),
{walk("w1", f"i0 CROSS JOIN {values.format('a')} CROSS JOIN {values.format('b')} CROSS JOIN {values.format('g')}")},
{winner("b1", "w1")},
fg AS (SELECT DISTINCT series_id, {around("a")}, {around("b")}, {around("g")} FROM b1 CROSS JOIN {offsets.format("a")} CROSS JOIN {offsets.format("b")} CROSS JOIN {offsets.format("g")}),
{walk("w2", "i0 JOIN fg ON fg.series_id = i0.series_id")},
{winner("b2", "w2")},
er AS (SELECT m.series_id, quantile_cont(m.value - {guess}, 0.1) AS lo, quantile_cont(m.value - {guess}, 0.9) AS hi, max(m.ts) AS origin_ts
  FROM b2 JOIN w2 h ON h.series_id = b2.series_id AND h.a = b2.a AND h.b = b2.b AND h.g = b2.g
  JOIN m ON m.series_id = h.series_id AND m.rn = h.rn + 1 GROUP BY 1),
fc AS (SELECT series_id, h, {path} AS yhat, {path} + lo AS lower, {path} + hi AS upper, origin_ts FROM b2 JOIN er USING (series_id) CROSS JOIN hz)"""


@query("forecast_mean", v.with_(v.M, H12, MEAN) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return baseline.forecast_mean(v.monthly(spark, sf), 12, MONTH)


@query("forecast_naive", v.with_(v.M, H12, NAIVE) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return baseline.forecast_naive(v.monthly(spark, sf), 12, MONTH)


@query("forecast_snaive", v.with_(v.M, H12, SNAIVE) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return baseline.forecast_snaive(v.monthly(spark, sf), 12, MONTH, season=7)


@query("forecast_ses", v.with_recursive(v.M, H12, SES_FC) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return smoothing.forecast_ses(v.monthly(spark, sf), 12, MONTH)


@query("forecast_holt", v.with_recursive(v.M, H12, HOLT) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return smoothing.forecast_holt(v.monthly(spark, sf), 12, MONTH)


@query("forecast_hw_add", v.with_recursive(v.M, seasonal_sql("add", 12)) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return smoothing.forecast_hw_add(v.monthly(spark, sf), 12, MONTH, period=12)


@query("forecast_hw_mul", v.with_recursive(v.M, seasonal_sql("mul", 12)) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return smoothing.forecast_hw_mul(v.monthly(spark, sf), 12, MONTH, period=12)


AR1 = """x AS (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM m),
c AS (SELECT series_id, regr_slope(value, p) AS b, regr_intercept(value, p) AS a, arg_max(value, ts) AS last, max(ts) AS origin_ts FROM x GROUP BY 1),
q AS (SELECT x.series_id, quantile_cont(value - a - b * p, 0.1) AS lo, quantile_cont(value - a - b * p, 0.9) AS hi FROM x JOIN c USING (series_id) GROUP BY 1),
fc AS (SELECT series_id, h, a * (1 - pow(b, h)) / (1 - b) + pow(b, h) * last AS yhat,
  a * (1 - pow(b, h)) / (1 - b) + pow(b, h) * last + lo * sqrt((1 - pow(b * b, h)) / (1 - b * b)) AS lower,
  a * (1 - pow(b, h)) / (1 - b) + pow(b, h) * last + hi * sqrt((1 - pow(b * b, h)) / (1 - b * b)) AS upper, origin_ts
  FROM c JOIN q USING (series_id) CROSS JOIN hz)"""


@query("ar1", v.with_(v.M, H12, AR1) + f"SELECT {OUT} FROM fc", digits=4)
def _(spark, sf):
    return arima.forecast_arima(v.monthly(spark, sf), 12, MONTH, order=(1, 0, 0))


@query("forecast_arima")
def _(spark, sf):
    return arima.forecast_arima(v.monthly(spark, sf), 12, MONTH, order=(1, 1, 1))


@query("forecast_sarima")
def _(spark, sf):
    return arima.forecast_sarima(v.monthly(spark, sf), 12, MONTH, order=(1, 0, 1), seasonal=(1, 1, 1, 12))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("forecast_var")
def _(spark, sf):
    return var.forecast_var(v.monthly(spark, sf), PRIORITIES, 12, MONTH, p=2)


@query("forecast_varma")
def _(spark, sf):
    return var.forecast_var(v.monthly(spark, sf), PRIORITIES, 12, MONTH, p=2, q=1)


HOLIDAYS = [(f"{year}-{day}", name) for year in range(1995, 2003) for day, name in (("01-01", "new year"), ("12-25", "christmas"))]


@query("forecast_structural")
def _(spark, sf):
    return structural.forecast_structural(v.daily_orders(spark, sf), 30, DAY, holidays=HOLIDAYS)


def features(spark, sf):
    return feature_matrix(v.hourly(spark, sf), HOUR, lags=HOURLY_LAGS, windows=HOURLY_WINDOWS)


# The usual forest size.  A fit takes about 6 s on 8 cores at this depth, 15 s at depth 12.
TREES, DEPTH = 100, 8


def time_split(spark, sf):
    """The first 80 % of each series train, the rest is scored."""
    parts = split_fraction(features(spark, sf), 0.2)
    return [parts.where(F.col("part") == p).drop("part") for p in ("train", "validation")]


def recursive(spark, sf):
    panel = last_window(v.hourly(spark, sf), weeks=12)
    rows = feature_matrix(panel, HOUR, lags=HOURLY_LAGS, windows=HOURLY_WINDOWS)
    model = forest.fit_random_forest(rows, n_trees=TREES, max_depth=DEPTH)
    return forest.forecast_recursive(panel, model, 120, HOUR, lags=HOURLY_LAGS, windows=HOURLY_WINDOWS)


def interval(spark, sf):
    train, check = time_split(spark, sf)
    return forest.forest_interval(forest.fit_random_forest(train, n_trees=TREES, max_depth=DEPTH), check)


def boosted(spark, sf):
    train, check = time_split(spark, sf)
    return forest.predict(forest.fit_gbt(train), check)


@query("forest_recursive")
def _(spark, sf):
    return recursive(spark, sf)


@query("forest_interval")
def _(spark, sf):
    return interval(spark, sf)


@query("forest_grid")
def _(spark, sf):
    grid = [{"n_trees": n, "max_depth": d} for n in (TREES, 2 * TREES) for d in (4, 6, DEPTH)]
    return forest.grid_search_forest(features(spark, sf), grid)[1].select("trial", "params", "rmse")


@query("gbt_predict")
def _(spark, sf):
    return boosted(spark, sf)


def shape_of(rows, *, band: bool = True):
    """Per series: rows, rows with a number, rows in order (lower <= upper, where there is a band)."""
    fine = F.col("lower") <= F.col("upper") if band else F.col("yhat").isNotNull()
    return rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count("yhat").alias("n_known"), F.count_if(fine).alias("n_in_order"))


# What SQL can say of the tree models: which rows they score, and that their bands are bands.
SCORED = """c AS (SELECT series_id, CAST(count(*) - floor(count(*) * 0.8) AS BIGINT) AS k FROM t WHERE rn > 24 GROUP BY 1)
SELECT series_id, k AS n_rows, k AS n_known, k AS n_in_order FROM c"""


@query("forest_interval_check", v.with_(v.T, SCORED))
def _(spark, sf):
    return shape_of(interval(spark, sf))


@query("gbt_predict_check", v.with_(v.T, SCORED))
def _(spark, sf):
    return shape_of(boosted(spark, sf), band=False)


AHEAD = "SELECT series_id, {0} AS n_rows, {0} AS n_known, {0} AS n_in_order FROM {1} GROUP BY 1"


@query("forest_recursive_check", v.with_(v.T) + AHEAD.format(120, "t"))
def _(spark, sf):
    return shape_of(recursive(spark, sf))


@query("forecast_structural_check", v.with_(v.D) + AHEAD.format(30, "d"))
def _(spark, sf):
    made = structural.forecast_structural(v.daily_orders(spark, sf), 30, DAY, holidays=HOLIDAYS)
    return shape_of(made)


@query("forecast_sarima_check", v.with_(v.M) + AHEAD.format(12, "m"))
def _(spark, sf):
    return shape_of(arima.forecast_sarima(v.monthly(spark, sf), 12, MONTH, order=(1, 0, 1), seasonal=(1, 1, 1, 12)))


@query("forecast_quantile_regression", digits=3)
def _(spark, sf):
    return quantile.forecast_quantile_regression(v.hourly(spark, sf), 168, HOUR)


# Three levels of every series, each a minimum of its loss, with about its share of rows below: within 11 rows, one for
# each coefficient that the fit may pass through.
@query("quantile_regression_check", v.with_(v.T) + """
SELECT series_id, prob, true AS is_minimum, true AS right_share FROM (SELECT DISTINCT series_id FROM t) CROSS JOIN (VALUES (0.1::DOUBLE), (0.5), (0.9)) p(prob)""")
def _(spark, sf):
    panel, probs = v.hourly(spark, sf), [0.1, 0.5, 0.9]
    rows = quantile.pinball_balance(panel, probs, quantile.fit_quantile_regression(panel, probs))
    sizes = panel.groupBy("series_id").agg(F.count("value").alias("n"))
    share = F.abs(F.col("share") - F.col("prob")) * F.col("n") <= 11.5
    return rows.join(sizes, "series_id").select("series_id", "prob", "is_minimum", share.alias("right_share"))


@query("forecast_quantile", v.with_(v.T) + """,
q AS (SELECT series_id, hour(ts) AS hh, isodow(ts) AS dd, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.5) AS md, quantile_cont(value, 0.9) AS hi
  FROM t GROUP BY 1, 2, 3),
f AS (SELECT series_id, max(ts) AS origin_ts FROM t GROUP BY 1),
g AS (SELECT series_id, origin_ts, h, origin_ts + to_hours(CAST(h AS INTEGER)) AS ts FROM f CROSS JOIN (SELECT unnest(generate_series(1, 168)) AS h))
SELECT g.series_id, h, ts, round(md, 6) AS yhat, round(lo, 6) AS lower, round(hi, 6) AS upper, origin_ts
FROM g LEFT JOIN q ON q.series_id = g.series_id AND hh = hour(ts) AND dd = isodow(ts)""".replace("\n,", ",", 1))
def _(spark, sf):
    return baseline.forecast_quantile(v.hourly(spark, sf), 168, HOUR)


@query("forecast_contract", v.with_(v.M, H12, SNAIVE) + """
SELECT series_id AS asset_id, CAST(origin_ts + to_months(CAST(h AS INTEGER)) AS TIMESTAMP) AS timestamp, round(yhat, 4) AS yhat,
  round(least(lower, upper), 4) AS lower, round(greatest(lower, upper), 4) AS upper, 'snaive-7' AS model_version, origin_ts AS forecast_ts FROM fc""", digits=4)
def _(spark, sf):
    made = baseline.forecast_snaive(v.monthly(spark, sf), 12, MONTH, season=7)
    return check_contract(to_contract(made, "snaive-7"))


@query("fit_status", v.with_(v.U) + """
SELECT series_id, count(value) AS n, CASE WHEN count(value) >= 60 THEN 'ok' ELSE 'too_short' END AS status FROM u GROUP BY 1""")
def _(spark, sf):
    return baseline.fit_status(v.user_events(spark, sf), 60)
