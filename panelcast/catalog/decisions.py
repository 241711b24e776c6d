"""Decision queries on a seasonal naive forecast of the hourly panel's last five days."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.anomalies import HOLDOUT, holdout
from panelcast.catalog.registry import query
from panelcast.operators import decision
from panelcast.operators.clean import regularize, split_last
from panelcast.operators.forecast.baseline import forecast_snaive
from panelcast.operators.forecast.contract import to_contract
from panelcast.operators.windows import difference
from panelcast.plans.grid import DAY, HOUR, MONTH
from panelcast.sources.shapes import canonicalize

FC = HOLDOUT + """,
fo AS (SELECT series_id, max(ts) AS made FROM tr GROUP BY 1),
fc AS (SELECT rs.series_id AS asset_id, rs.ts AS timestamp, yhat, least(lower, upper) AS lower, greatest(lower, upper) AS upper FROM rs)"""

SC = """rd AS (SELECT series_id, CAST(ts AS DATE) AS day, hour(ts) AS k, value - prev AS r FROM tr WHERE prev IS NOT NULL),
wd AS (SELECT DISTINCT day FROM rd),
sc AS (SELECT rs.series_id AS asset_id, rs.ts AS timestamp, date_diff('day', wd.day, CAST(made AS DATE)) AS scenario_id, yhat + r AS value
  FROM rs JOIN fo USING (series_id) CROSS JOIN wd LEFT JOIN rd ON rd.series_id = rs.series_id AND rd.day = wd.day AND rd.k = hour(rs.ts))"""

PR = """pr AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, round(avg(value), 6) AS price FROM events GROUP BY 1)"""

PD = """pd AS (SELECT sc.asset_id, sc.timestamp, round(0.8 * fc.yhat, 6) AS volume, avg((sc.value >= round(0.8 * fc.yhat, 6))::INT) AS p_delivery
  FROM sc JOIN fc USING (asset_id, timestamp) GROUP BY 1, 2, 3)"""


def forecast(spark, sf):
    return holdout(spark, sf)[1]


def history(spark, sf):
    return split_last(v.hourly(spark, sf), 120, step=HOUR).where("part = 'train'").drop("part")


def residuals(spark, sf):
    changes = difference(history(spark, sf), HOUR, n=0, seasonal=24)
    return changes.select("series_id", "ts", F.col("diff").alias("resid"))


def paths(spark, sf):
    return decision.scenarios(forecast(spark, sf), residuals(spark, sf), HOUR)


def prices(spark, sf):
    events = v.table(spark, sf, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return events.groupBy(hour.alias("timestamp")).agg(F.round(F.avg("value"), 6).alias("price"))


def promised(spark, sf):
    return forecast(spark, sf).withColumn("volume", F.round(0.8 * F.col("yhat"), 6))


@query("forecast_profile", v.with_(v.T, FC) + """,
r AS (SELECT *, yhat - lag(yhat) OVER (PARTITION BY asset_id ORDER BY timestamp) AS ramp FROM fc)
SELECT asset_id, CAST(timestamp AS DATE) AS date, round(sum(yhat), 6) AS energy, round(max(yhat), 6) AS peak, min_by(timestamp, [-yhat, epoch(timestamp)]) AS peak_ts,
  round(min(yhat), 6) AS trough, round(max(abs(ramp)), 6) AS max_ramp, min_by(timestamp, [-abs(ramp), epoch(timestamp)]) FILTER (ramp IS NOT NULL) AS max_ramp_ts
FROM r GROUP BY 1, 2""".replace("\n,", ",", 1))
def _(spark, sf):
    return decision.forecast_profile(forecast(spark, sf), HOUR)


@query("uncertainty", v.with_(v.T, FC) + """
SELECT asset_id, timestamp, round(yhat, 6) AS yhat, round(upper - lower, 6) AS uncertainty, round((upper - lower) / nullif(abs(yhat), 0), 6) AS relative_uncertainty,
  round(lower, 6) AS conservative FROM fc""")
def _(spark, sf):
    return decision.uncertainty(forecast(spark, sf))


@query("scenarios", v.with_(v.T, FC, SC) + "SELECT asset_id, timestamp, scenario_id, round(value, 6) AS value FROM sc")
def _(spark, sf):
    return paths(spark, sf)


@query("event_probability", v.with_(v.T, FC, SC) + """
SELECT asset_id, timestamp, count(value) AS n_scenarios, round(avg((value > 150)::INT), 6) AS probability FROM sc GROUP BY 1, 2""")
def _(spark, sf):
    return decision.event_probability(paths(spark, sf), 150.0)


def cdf_sql(z: str) -> str:
    """The same published polynomial the operator uses."""
    from panelcast.catalog.diagnostics import horner
    from panelcast.functions.numeric import CDF_B, CDF_P

    t = f"(1 / (1 + {CDF_P} * abs({z})))"
    tail = f"exp(-({z}) * ({z}) / 2) / 2.5066282746310002 * {horner([0.0, *CDF_B], t)}"
    return f"(CASE WHEN {z} >= 0 THEN 1 - {tail} ELSE {tail} END)"


@query("event_probability_normal", v.with_(v.T, FC) + f""",
z AS (SELECT *, (150 - yhat) / nullif((upper - lower) / (2 * 1.2815515655446004), 0) AS z FROM fc)
SELECT asset_id, timestamp, round(1 - {cdf_sql('z')}, 4) AS probability FROM z""".replace("\n,", ",", 1), digits=4)
def _(spark, sf):
    return decision.event_probability_normal(forecast(spark, sf), 150.0)


@query("expected_events", v.with_(v.T, FC) + """,
g AS (SELECT *, yhat > 100 AS flag FROM fc),
i AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY timestamp) - row_number() OVER (PARTITION BY asset_id, flag ORDER BY timestamp) AS grp FROM g)
SELECT asset_id, min(timestamp) AS start_ts, max(timestamp) + INTERVAL 1 HOUR AS stop_ts, count(*) AS n_steps, round(max(yhat), 6) AS peak,
  min_by(timestamp, [-yhat, epoch(timestamp)]) AS peak_ts, round(sum(yhat), 6) AS energy FROM i WHERE flag GROUP BY asset_id, grp HAVING count(*) >= 2""".replace("\n,", ",", 1))
def _(spark, sf):
    return decision.expected_events(forecast(spark, sf), HOUR, on=100.0, min_run=2)


@query("regime_changes", v.with_(v.T, FC) + """,
g AS (SELECT *, CAST((yhat > 50)::INT + (yhat > 200)::INT AS BIGINT) AS regime FROM fc),
h AS (SELECT asset_id, timestamp, lag(regime) OVER (PARTITION BY asset_id ORDER BY timestamp) AS previous, regime FROM g)
SELECT * FROM h WHERE previous <> regime""".replace("\n,", ",", 1))
def _(spark, sf):
    return decision.regime_changes(forecast(spark, sf), HOUR, [50.0, 200.0])


# Every hour from 17 to 20 o'clock of all days, those before the forecast begins too, so some steps have no baseline.
@query("baseline_response", v.with_(v.T, FC) + """,
ev AS (SELECT DISTINCT series_id, date_trunc('day', ts)::TIMESTAMP AS day FROM t),
st AS (SELECT series_id, day, day + INTERVAL 1 HOUR * unnest([17, 18, 19]) AS ts FROM ev),
jo AS (SELECT st.*, t.value, rs.yhat, rs.yhat - t.value AS gain FROM st LEFT JOIN t USING (series_id, ts) LEFT JOIN rs ON rs.series_id = st.series_id AND rs.ts = st.ts)
SELECT series_id || '/' || strftime(day, '%Y-%m-%d') AS event_id, series_id AS asset_id, day + INTERVAL 17 HOUR AS start_ts, day + INTERVAL 20 HOUR AS end_ts,
  count(*) AS n_steps, count(*) - count(gain) AS n_missing, round(sum(yhat) FILTER (gain IS NOT NULL), 6) AS baseline,
  round(sum(value) FILTER (gain IS NOT NULL), 6) AS observed, round(sum(gain), 6) AS response FROM jo GROUP BY 1, 2, 3, 4""".replace("\n,", ",", 1))
def _(spark, sf):
    _, made = holdout(spark, sf)
    metering = v.hourly(spark, sf)
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    events = metering.select(
        F.concat_ws("/", "series_id", F.to_date("ts").cast("string")).alias("event_id"),
        F.col("series_id").alias("asset_id"),
        (day + F.expr("INTERVAL 17 HOURS")).alias("start_ts"),
        (day + F.expr("INTERVAL 20 HOURS")).alias("end_ts"),
    ).distinct()
    return decision.baseline_response(events, metering, made, HOUR)


@query("portfolio_forecast", v.with_(v.T, FC) + "SELECT timestamp, round(sum(yhat), 6) AS yhat, count(yhat) AS n_assets FROM fc GROUP BY 1")
def _(spark, sf):
    return decision.portfolio_forecast(forecast(spark, sf))


NATIONS = """mo AS (SELECT n_name AS series_id, date_trunc('month', o_orderdate)::TIMESTAMP AS ts, round(sum(o_totalprice), 4) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
ml AS (SELECT * FROM mo WHERE ts + INTERVAL 1 MONTH <= (SELECT max(o_orderdate)::TIMESTAMP + INTERVAL 1 DAY FROM orders)),
mg AS (SELECT s.series_id, g.ts FROM (SELECT DISTINCT series_id FROM ml) s CROSS JOIN
  (SELECT unnest(generate_series((SELECT min(ts) FROM ml), (SELECT max(ts) FROM ml), INTERVAL 1 MONTH)) AS ts) g),
m AS (SELECT mg.series_id, mg.ts, coalesce(ml.value, 0.0) AS value FROM mg LEFT JOIN ml USING (series_id, ts)),
fc AS (SELECT series_id, CAST(ts + INTERVAL 12 MONTH AS TIMESTAMP) AS timestamp, value AS yhat FROM m WHERE ts > (SELECT max(ts) FROM m) - INTERVAL 12 MONTH),
hy AS (SELECT fc.*, r_name AS region, n_name AS nation FROM fc JOIN nation ON n_name = series_id JOIN region ON r_regionkey = n_regionkey)"""


@query("portfolio_hierarchy", v.with_(NATIONS) + """
SELECT timestamp, region, nation, round(sum(yhat), 2) AS yhat, count(yhat) AS n_assets, CAST((region IS NOT NULL)::INT + (nation IS NOT NULL)::INT AS BIGINT) AS depth
FROM hy GROUP BY GROUPING SETS ((timestamp), (timestamp, region), (timestamp, region, nation))""", digits=2)
def _(spark, sf):
    def t(name):
        return v.table(spark, sf, name)

    nation = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = nation.select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    named = orders.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    panel = canonicalize(named, {"series_id": "nation", "ts": "o_orderdate", "value": "o_totalprice"})
    monthly = regularize(panel, MONTH, span="panel", fill=0.0, drop_partial=True, resolution=DAY)
    made = to_contract(forecast_snaive(monthly, 12, MONTH, season=12), "snaive-12")
    placed = made.join(places, F.col("asset_id") == F.col("nation"))
    return decision.portfolio_forecast(placed, ["region", "nation"])


@query("portfolio_uncertainty", v.with_(v.T, FC) + """,
e AS (SELECT series_id, ts, value - prev AS r FROM tr WHERE prev IS NOT NULL),
s AS (SELECT ts, sum(r) AS s, count(DISTINCT series_id) AS n FROM e GROUP BY 1),
p AS (SELECT count(*) AS n_steps, stddev_samp(s) AS sp, avg(n) AS n FROM s),
i AS (SELECT count(*) AS n_assets, sqrt(sum(v)) AS si FROM (SELECT series_id, var_samp(r) AS v FROM e GROUP BY 1))
SELECT n_steps, round(sp, 6) AS sigma_portfolio, n_assets, round(si, 6) AS sigma_independent, round(sp / si, 6) AS diversification, round(n / n_assets, 6) AS presence FROM p CROSS JOIN i""".replace("\n,", ",", 1))
def _(spark, sf):
    return decision.portfolio_uncertainty(residuals(spark, sf))


FLEX = """cp AS (SELECT series_id, hour(ts) AS hh, isodow(ts) AS dd, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM tr GROUP BY 1, 2, 3),
ch AS (SELECT series_id, hour(ts) AS hh, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM tr GROUP BY 1, 2),
ca AS (SELECT series_id, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM tr GROUP BY 1),
lm AS (SELECT series_id, max(abs(d)) AS lim FROM (SELECT series_id, value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS d FROM tr) GROUP BY 1),
fx AS (SELECT fc.asset_id, fc.timestamp, yhat, least(greatest(yhat - coalesce(cp.lo, ch.lo, ca.lo), 0), lim) AS reduction,
  least(greatest(coalesce(cp.hi, ch.hi, ca.hi) - yhat, 0), lim) AS increase
  FROM fc LEFT JOIN cp ON cp.series_id = asset_id AND cp.hh = hour(timestamp) AND cp.dd = isodow(timestamp) LEFT JOIN ch ON ch.series_id = asset_id AND ch.hh = hour(timestamp)
  LEFT JOIN ca ON ca.series_id = asset_id LEFT JOIN lm ON lm.series_id = asset_id)"""


@query("flex_envelope", v.with_(v.T, FC, FLEX) + """
SELECT asset_id, timestamp, round(yhat, 6) AS yhat, round(reduction, 6) AS reduction, round(increase, 6) AS increase FROM fx""")
def _(spark, sf):
    return decision.flex_envelope(forecast(spark, sf), history(spark, sf), HOUR)


@query("portfolio_flexibility", v.with_(v.T, FC, FLEX) + """
SELECT timestamp, round(sum(reduction), 6) AS reduction, round(sum(increase), 6) AS increase, count(*) AS n_assets FROM fx GROUP BY 1""")
def _(spark, sf):
    return decision.portfolio_flexibility(decision.flex_envelope(forecast(spark, sf), history(spark, sf), HOUR))


@query("soc_envelope", v.with_recursive(v.T, FC) + """,
c AS (SELECT asset_id, timestamp, round(yhat - 100, 6) AS y, row_number() OVER (PARTITION BY asset_id ORDER BY timestamp) AS i FROM fc),
w AS (SELECT asset_id, timestamp, i, least(greatest(200.0 + y, 0.0), 1000.0)::DOUBLE AS soc FROM c WHERE i = 1
  UNION ALL SELECT c.asset_id, c.timestamp, c.i, least(greatest(w.soc + c.y, 0.0), 1000.0) FROM w JOIN c ON c.asset_id = w.asset_id AND c.i = w.i + 1)
SELECT asset_id, timestamp, round(soc, 6) AS soc, round(1000 - soc, 6) AS headroom,
  min(CASE WHEN soc >= 400 THEN timestamp END) OVER (PARTITION BY asset_id) AS first_reached_ts FROM w""".replace("\n,", ",", 1))
def _(spark, sf):
    net = forecast(spark, sf).withColumn("yhat", F.round(F.col("yhat") - 100, 6))
    return decision.soc_envelope(net, capacity=1000.0, soc0=200.0, target=400.0)


@query("tradable_volume", v.with_(v.T, FC, SC, PD) + """
SELECT asset_id, timestamp, volume, round(p_delivery, 6) AS p_delivery, round(volume * p_delivery, 6) AS tradable FROM pd""")
def _(spark, sf):
    return decision.tradable_volume(paths(spark, sf), promised(spark, sf))


@query("tradable_volume_q10", v.with_(v.T, FC, SC) + """
SELECT fc.asset_id, fc.timestamp, round(0.8 * yhat, 6) AS volume, round(q, 6) AS tradable FROM fc
JOIN (SELECT asset_id, timestamp, quantile_cont(value, 0.1) AS q FROM sc GROUP BY 1, 2) USING (asset_id, timestamp)""")
def _(spark, sf):
    return decision.tradable_volume(paths(spark, sf), promised(spark, sf), mode="q10")


VALUE = "ov AS (SELECT asset_id, timestamp, volume, p_delivery, price, volume * price * p_delivery AS expected_value FROM pd JOIN pr USING (timestamp))"


def opportunities(spark, sf):
    volumes = decision.delivery_probability(paths(spark, sf), promised(spark, sf))
    return decision.opportunity_value(volumes, prices(spark, sf))


@query("opportunity_value", v.with_(v.T, FC, SC, PD, PR, VALUE) + """
SELECT asset_id, timestamp, volume, round(p_delivery, 6) AS p_delivery, price, round(expected_value, 2) AS expected_value FROM ov""")
def _(spark, sf):
    return opportunities(spark, sf).withColumn("expected_value", F.round("expected_value", 2))


@query("rank_opportunities", v.with_(v.T, FC, SC, PD, PR, VALUE) + """
SELECT asset_id, timestamp, volume, round(p_delivery, 6) AS p_delivery, price, round(expected_value, 2) AS expected_value, r AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY CAST(timestamp AS DATE) ORDER BY round(expected_value, 2) DESC, asset_id, timestamp) AS r FROM ov) WHERE r <= 10""")
def _(spark, sf):
    values = opportunities(spark, sf).withColumn("expected_value", F.round("expected_value", 2))
    return decision.rank_opportunities(values, 10, per="date")


@query("robust_value", v.with_(v.T, FC, SC, PR) + """
SELECT asset_id, timestamp, round(avg(value * price), 2) AS mean_value, round(quantile_cont(value * price, 0.1), 2) AS q10_value
FROM sc JOIN pr USING (timestamp) GROUP BY 1, 2""", digits=2)
def _(spark, sf):
    return decision.robust_value(paths(spark, sf), prices(spark, sf))
