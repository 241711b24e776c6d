"""Autocorrelation, decomposition and residual queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from panelcast.catalog import views as v
from panelcast.catalog.anomalies import decompose_sql
from panelcast.catalog.registry import query
from panelcast.functions.numeric import CDF_B, CDF_P, box_cox, inv_box_cox
from panelcast.operators import similarity, stats
from panelcast.plans.grid import DAY, HOUR

ACF = """ct AS (SELECT series_id, rn, value - avg(value) OVER (PARTITION BY series_id) AS c, count(*) OVER (PARTITION BY series_id) AS n FROM t),
ss AS (SELECT series_id, sum(c * c) AS ss FROM ct GROUP BY 1),
ac AS (SELECT a.series_id, l.lag, max(a.n) AS n, sum(a.c * b.c) / nullif(max(ss.ss), 0) AS acf FROM ct a
  CROSS JOIN (SELECT unnest(generate_series(1, 48)) AS lag) l JOIN ct b ON a.series_id = b.series_id AND b.rn = a.rn + l.lag
  JOIN ss ON ss.series_id = a.series_id GROUP BY 1, 2)"""


@query("acf", v.with_(v.T, ACF) + "SELECT series_id, n, lag, round(acf, 6) AS acf FROM ac")
def _(spark, sf):
    return stats.acf(v.hourly(spark, sf), 48, HOUR)


@query("pacf", v.with_recursive(v.T, ACF) + """,
rl AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM ac WHERE lag <= 40 GROUP BY 1),
dl AS (SELECT series_id, r, 1 AS k, [r[1]] AS phi, 1 - r[1] * r[1] AS scale FROM rl
  UNION ALL SELECT series_id, r, k + 1, list_append(list_transform(phi, lambda x, j: x - nw * phi[k + 1 - j]), nw), scale * (1 - nw * nw)
  FROM (SELECT *, (r[k + 1] - list_sum(list_transform(phi, lambda x, j: x * r[k + 1 - j]))) / scale AS nw FROM dl WHERE k < 40))
SELECT series_id, CAST(k AS BIGINT) AS lag, round(phi[k], 6) AS pacf FROM dl""".replace("\n,", ",", 1))
def _(spark, sf):
    return stats.pacf(v.hourly(spark, sf), 40, HOUR)


# The definition searches min(100, n - 1) lags.
@query("dominant_lag", v.with_(v.T, ACF.replace("generate_series(1, 48)", "generate_series(1, 100)")) + """
SELECT series_id, lag AS dominant_lag, round(acf, 6) AS acf FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY acf DESC, lag) AS r FROM ac) WHERE r = 1""")
def _(spark, sf):
    return stats.dominant_lag(stats.acf(v.hourly(spark, sf), 100, HOUR))


@query("ljung_box", v.with_(v.T, ACF) + "SELECT series_id, round(max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)), 6) AS ljung_box FROM ac GROUP BY 1")
def _(spark, sf):
    return stats.ljung_box(stats.acf(v.hourly(spark, sf), 48, HOUR))


@query("decompose", v.with_(v.T, decompose_sql(24)) + """
SELECT series_id, ts, value, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(resid, 6) AS resid FROM dc""")
def _(spark, sf):
    return stats.decompose(v.hourly(spark, sf), 24, HOUR)


def multiplicative_sql(period: int) -> str:
    half = period // 2
    frame = f"OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    w = "OVER (PARTITION BY series_id ORDER BY ts)"
    return f"""pa AS (SELECT *, CASE WHEN count(value) {frame} = {2 * half + 1} THEN
  (sum(value) {frame} - (lag(value, {half}) {w} + lead(value, {half}) {w}) / 2) / {period} END AS trend FROM m),
pb AS (SELECT series_id, rn % {period} AS ph, avg(value / nullif(trend, 0)) AS s FROM pa GROUP BY 1, 2),
pc AS (SELECT series_id, ph, s / avg(s) OVER (PARTITION BY series_id) AS seasonal FROM pb)"""


@query("decompose_mul", v.with_(v.M, multiplicative_sql(12)) + """
SELECT a.series_id, a.ts, a.value, round(a.trend, 6) AS trend, round(c.seasonal, 6) AS seasonal,
  round(a.value / nullif(a.trend * c.seasonal, 0), 6) AS resid FROM pa a JOIN pc c ON a.series_id = c.series_id AND a.rn % 12 = c.ph""")
def _(spark, sf):
    return stats.decompose(v.monthly(spark, sf), 12, "month", model="multiplicative")


@query("seasonality_strength", v.with_(v.T, decompose_sql(24)) + """
SELECT series_id, round(greatest(0, 1 - var_samp(resid) / var_samp(CASE WHEN resid IS NOT NULL THEN seasonal + resid END)), 6) AS seasonality_strength
FROM dc GROUP BY 1""")
def _(spark, sf):
    return stats.seasonality_strength(stats.decompose(v.hourly(spark, sf), 24, HOUR))


@query("zscore", v.with_(v.T) + """
SELECT series_id, ts, value, round((value - avg(value) OVER s) / nullif(stddev_pop(value) OVER s, 0), 6) AS zscore FROM t
WINDOW s AS (PARTITION BY series_id)""")
def _(spark, sf):
    return stats.zscore(v.hourly(spark, sf))


@query("correlation_pairs", v.with_(v.T) + """
SELECT a.series_id AS id_a, b.series_id AS id_b, count(*) AS n, round(corr(a.value, b.value), 6) AS corr
FROM t a JOIN t b ON a.ts = b.ts AND a.series_id < b.series_id GROUP BY 1, 2""")
def _(spark, sf):
    return similarity.correlation_matrix(v.hourly(spark, sf), HOUR)


LAM = "0.40136288976843615"


@query("boxcox", v.with_(v.U) + f"""
SELECT series_id, ts, round(value, 6) AS value, round(CASE WHEN value > 0 THEN (pow(value, {LAM}) - 1) / {LAM} END, 6) AS transformed,
  round(CASE WHEN value > 0 THEN value END, 6) AS restored FROM u""")
def _(spark, sf):
    t = v.user_events(spark, sf).withColumn("transformed", box_cox(F.col("value")))
    return t.withColumn("restored", inv_box_cox(F.col("transformed")))


def horner(coefs, x: str) -> str:
    out = repr(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = f"({out} * {x} + {c!r})"
    return out


def ppnd_sql(p: str) -> str:
    from panelcast.functions import numeric as m

    q, r = f"({p} - 0.5)", f"sqrt(-ln(CASE WHEN {p} < 0.5 THEN {p} ELSE 1 - {p} END))"
    r1 = f"(0.180625 - {q} * {q})"
    middle = f"{q} * {horner(m.PPND_A, r1)} / {horner(m.PPND_B, r1)}"
    near = f"{horner(m.PPND_C, f'({r} - 1.6)')} / {horner(m.PPND_D, f'({r} - 1.6)')}"
    far = f"{horner(m.PPND_E, f'({r} - 5.0)')} / {horner(m.PPND_F, f'({r} - 5.0)')}"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {middle} ELSE sign({q}) * CASE WHEN {r} <= 5 THEN {near} ELSE {far} END END"


@query("qq_points", v.with_(v.T, decompose_sql(24)) + f""",
rk AS (SELECT series_id, resid AS value, row_number() OVER (PARTITION BY series_id ORDER BY resid) AS i,
  count(*) OVER (PARTITION BY series_id) AS n FROM dc WHERE resid IS NOT NULL),
pp AS (SELECT *, i / (n + 1)::DOUBLE AS p FROM rk)
SELECT series_id, i, round(value, 6) AS value, round({ppnd_sql('p')}, 6) AS theoretical FROM pp""".replace("\n,", ",", 1))
def _(spark, sf):
    return stats.qq_points(stats.decompose(v.hourly(spark, sf), 24, HOUR), "resid")


@query("residual_moments", v.with_(v.T, decompose_sql(24)) + """,
p AS (SELECT series_id, count(resid) AS n, avg(resid) AS m, stddev_samp(resid) AS sd, stddev_pop(resid) AS sp FROM dc GROUP BY 1),
q AS (SELECT dc.series_id, max(p.n) AS n, max(p.m) AS m, max(p.sd) AS sd, avg(pow((resid - p.m) / p.sp, 3)) AS sk,
  avg(pow((resid - p.m) / p.sp, 4)) - 3 AS ku FROM dc JOIN p USING (series_id) GROUP BY 1)
SELECT series_id, n, round(m, 6) AS mean, round(sd, 6) AS std, round(sk, 6) AS skewness, round(ku, 6) AS kurtosis,
  round(n / 6.0 * (sk * sk + ku * ku / 4), 6) AS jarque_bera FROM q""".replace("\n,", ",", 1))
def _(spark, sf):
    return stats.residual_moments(stats.decompose(v.hourly(spark, sf), 24, HOUR), "resid")


@query("residual_histogram", v.with_(v.T) + """,
z AS (SELECT series_id, (value - avg(value) OVER s) / stddev_pop(value) OVER s AS z FROM t WINDOW s AS (PARTITION BY series_id))
SELECT series_id, bin, count(*) AS n_rows, round(bin * 0.4::DOUBLE - 4.0, 6) AS bin_start FROM (
  SELECT series_id, CAST(least(greatest(floor((z + 4) / 8 * 20), 0), 19) AS BIGINT) AS bin FROM z) GROUP BY 1, 2""".replace("\n,", ",", 1))
def _(spark, sf):
    return stats.residual_histogram(v.hourly(spark, sf))


@query("residual_diagnostics", v.with_(v.T, decompose_sql(24)) + """,
e AS (SELECT series_id, resid AS value, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM dc WHERE resid IS NOT NULL),
p AS (SELECT series_id, count(*) AS n, avg(value) AS m, stddev_samp(value) AS sd, stddev_pop(value) AS sp FROM e GROUP BY 1),
c AS (SELECT e.series_id, rn, value - m AS c, n, (value - m) / sp AS z FROM e JOIN p USING (series_id)),
q AS (SELECT series_id, avg(pow(z, 3)) AS sk, avg(pow(z, 4)) - 3 AS ku, sum(c * c) AS ss FROM c GROUP BY 1),
r AS (SELECT a.series_id, lag, max(a.n) AS n, sum(a.c * b.c) / max(ss) AS acf FROM c a CROSS JOIN (SELECT unnest(generate_series(1, 24)) AS lag)
  JOIN c b ON a.series_id = b.series_id AND b.rn = a.rn + lag JOIN q ON q.series_id = a.series_id GROUP BY 1, 2),
lb AS (SELECT series_id, max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)) AS lb FROM r GROUP BY 1)
SELECT p.series_id, p.n, round(m, 6) AS mean, round(sd, 6) AS std, round(sk, 6) AS skewness, round(ku, 6) AS kurtosis,
  round(p.n / 6.0 * (sk * sk + ku * ku / 4), 6) AS jarque_bera, round(lb, 6) AS ljung_box
FROM p JOIN q USING (series_id) JOIN lb USING (series_id)""".replace("\n,", ",", 1))
def _(spark, sf):
    parts = stats.decompose(v.hourly(spark, sf), 24, HOUR)
    resid = parts.select("series_id", "ts", F.col("resid").alias("value")).where(F.col("value").isNotNull())
    return stats.residual_diagnostics(resid, 24, HOUR)


def _poly(coefs, x: str) -> str:
    return horner(list(coefs), x)


def p_value_sql(t: str) -> str:
    """The published approximation in full: two polynomials under the normal distribution function."""

    def cdf(z: str) -> str:
        inner = f"(1 / (1 + {CDF_P} * abs({z})))"
        tail = f"exp(-({z}) * ({z}) / 2) / 2.5066282746310002 * {horner([0.0, *CDF_B], inner)}"
        return f"(CASE WHEN {z} >= 0 THEN 1 - {tail} ELSE {tail} END)"

    small, large = _poly(stats.ADF_P_SMALL, t), _poly(stats.ADF_P_LARGE, t)
    return f"""CASE WHEN {t} > {stats.ADF_P_MAX} THEN 1.0 WHEN {t} < {stats.ADF_P_MIN} THEN 0.0
  WHEN {t} <= {stats.ADF_P_SPLIT} THEN {cdf(f"({small})")} ELSE {cdf(f"({large})")} END"""


def adf_sql(table: str, digits: int = 6) -> str:
    return f""",
x AS (SELECT series_id, value - lag(value) OVER w AS dy, lag(value) OVER w AS lv FROM {table} WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
f AS (SELECT series_id, count(dy) AS n, regr_slope(dy, lv) AS g, regr_sxx(dy, lv) AS sxx, regr_syy(dy, lv) AS syy, regr_sxy(dy, lv) AS sxy FROM x GROUP BY 1),
a AS (SELECT series_id, n, g, g / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS t FROM f)
SELECT series_id, n, round(g, {digits}) AS gamma, round(t, {digits}) AS adf, CAST(round({p_value_sql("t")}, {digits}) AS DOUBLE) AS p_value,
  {', '.join(f"round({_poly(c, '(1.0 / n)')}, {digits}) AS {name}" for name, c in stats.ADF_CRITICAL.items())} FROM a""".replace("\n,", ",", 1)


@query("adf_lag0", v.with_(v.D) + adf_sql("d"))
def _(spark, sf):
    return stats.adf_lag0(v.daily_orders(spark, sf), DAY)


# Running totals have a unit root, so the p-value is neither 0 nor 1 here.
@query("adf_lag0_totals", v.with_(v.D, "rt AS (SELECT series_id, ts, round(sum(value) OVER (PARTITION BY series_id ORDER BY ts) / 1000 + 50000 * sin(rn / 9.0), 2) AS value FROM d)") + adf_sql("rt", 5), digits=5)
def _(spark, sf):
    total = F.sum("value").over(Window.partitionBy("series_id").orderBy("ts"))
    place = F.row_number().over(Window.partitionBy("series_id").orderBy("ts"))
    rows = v.daily_orders(spark, sf).withColumn("value", F.round(total / 1000 + 50000 * F.sin(place / 9.0), 2))
    return stats.adf_lag0(rows, DAY)


def sweep_sql(name: str, source: str, width: int) -> str:
    """``name``: the product sums ``g`` (``width`` x ``width``, by rows) of ``source`` after each of its columns but the last is swept.

    Sweeping a column makes it a regressor: the last element is then the error sum of the regression on all swept ones.
    A column of zeros is passed over.
    """
    at = lambda r, c: f"g[({r} - 1) * {width} + {c}]"
    row, col, pivot = f"((i - 1) // {width} + 1)", f"((i - 1) % {width} + 1)", at("p", "p")
    swept = f"""list_transform(range(1, {width * width + 1}), lambda i: CASE WHEN {row} = p AND {col} = p THEN -1 / {pivot} WHEN {row} = p THEN {at('p', col)} / {pivot}
    WHEN {col} = p THEN {at(row, 'p')} / {pivot} ELSE {at(row, col)} - {at(row, 'p')} * {at('p', col)} / {pivot} END)"""
    return f"""{name} AS (SELECT *, 1 AS p FROM {source} UNION ALL
  SELECT * REPLACE (p + 1 AS p, CASE WHEN abs({pivot}) < 1e-9 THEN g ELSE {swept} END AS g) FROM {name} WHERE p < {width})"""


def adf_full_sql(table: str, lags: int, own: str) -> str:
    """The test with lagged changes: nested regressions by sweeping, the least AIC, and the chosen one on its longest sample."""
    names = ["lv", *[f"d{k}" for k in range(1, lags + 1)], "dy"]
    width = len(names)

    def sums(limit: str) -> str:
        masked = [n if n in ("lv", "dy") else f"CASE WHEN {limit} >= {n[1:]} THEN {n} ELSE 0 END" for n in names]
        return ", ".join(f"{m} AS {n}" for m, n in zip(masked, names))

    products = "[" + ", ".join(f"covar_pop({a}, {b}) * count(*)" for a in names for b in names) + "]"
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    changes = ", ".join(f"lag(dy, {k}) OVER w AS d{k}" for k in range(1, lags + 1))
    return f"""
ax AS (SELECT series_id, ts, value - lag(value) OVER w AS dy, lag(value) OVER w AS lv FROM {table} WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
ad AS (SELECT *, {changes} FROM ax WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
ao AS (SELECT series_id, {own} AS own FROM {table} GROUP BY 1),
az AS (SELECT series_id, own, {sums('own')} FROM ad JOIN ao USING (series_id)),
ag AS (SELECT series_id, own, count(*) AS n, {products} AS g FROM az WHERE {known} GROUP BY 1, 2),
{sweep_sql('sa', 'ag', width)},
ac1 AS (SELECT series_id, p - 2 AS lags, n * ln(g[{width * width}] / n) + 2 * p AS aic FROM sa WHERE p >= 2 AND p - 2 <= own),
ch AS (SELECT series_id, arg_min(lags, aic) AS lags FROM ac1 GROUP BY 1),
bz AS (SELECT series_id, lags, {sums('lags')} FROM ad JOIN ch USING (series_id)),
bg AS (SELECT series_id, lags, count(*) AS n, {products} AS g FROM bz WHERE {known} GROUP BY 1, 2),
{sweep_sql('sb', 'bg', width)},
af AS (SELECT series_id, CAST(lags AS BIGINT) AS lags, n, g[{width}] AS gamma, g[{width}] / sqrt(g[{width * width}] / (n - lags - 2) * -g[1]) AS t FROM sb WHERE p = {width})"""


USUAL_LAGS = "greatest(0, least(ceil(12 * pow(count(value) / 100.0, 0.25)), count(value) // 2 - 2))"


@query("adf_test", v.with_recursive(v.M, adf_full_sql("m", 12, "12")) + f"""
SELECT series_id, lags, n, round(t, 6) AS adf, round(gamma, 6) AS gamma, CAST(round({p_value_sql("t")}, 6) AS DOUBLE) AS p_value,
  {', '.join(f"round({_poly(c, '(1.0 / n)')}, 6) AS {name}" for name, c in stats.ADF_CRITICAL.items())} FROM af""")
def _(spark, sf):
    return stats.adf_test(v.monthly(spark, sf), "month", maxlag=12)


# 720 hours: 20 lags at most.
@query("check_stats", v.with_recursive(v.T, ACF, adf_full_sql("t", 20, USUAL_LAGS)) + """,
lb AS (SELECT series_id, max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)) AS lb FROM ac WHERE lag <= 24 GROUP BY 1),
p AS (SELECT series_id, count(*) AS n, count(*) FILTER (value IS NULL) AS nm, count(DISTINCT value) / count(value) AS ds, median(value) AS md,
  avg(value) AS m, stddev_samp(value) AS sd, stddev_pop(value) AS sp FROM t GROUP BY 1),
q AS (SELECT series_id, avg(pow((value - p.m) / p.sp, 3)) AS sk, avg(pow((value - p.m) / p.sp, 4)) - 3 AS ku FROM t JOIN p USING (series_id) GROUP BY 1)
SELECT p.series_id, p.n AS n_rows, p.nm AS n_missing, round(p.ds, 6) AS distinct_share, round(p.md, 6) AS median, round(p.m, 6) AS mean,
  round(p.sd, 6) AS std, round(q.sk, 6) AS skewness, round(q.ku, 6) AS kurtosis, round(p.n / 6.0 * (q.sk * q.sk + q.ku * q.ku / 4), 6) AS jarque_bera,
  lags AS adf_lags, round(af.t, 6) AS adf, round(lb.lb, 6) AS ljung_box
FROM p JOIN q USING (series_id) JOIN af USING (series_id) JOIN lb USING (series_id)""".replace("\n,", ",", 1))
def _(spark, sf):
    return stats.check_stats(v.hourly(spark, sf), 24, HOUR)
