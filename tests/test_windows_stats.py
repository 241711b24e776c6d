from __future__ import annotations

import random
from datetime import datetime, timedelta
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from panelcast.functions import box_cox, inv_box_cox, normal_cdf, normal_quantile
from panelcast.operators import anomaly, daily, stats, windows
from panelcast.operators.daily import quantiles
from panelcast.operators.ols import ols_fit
from panelcast.plans.grid import HOUR
from panelcast.plans.tiles import over_tiles, runs

RNG = np.random.default_rng(7)
WALK = np.cumsum(RNG.normal(size=150)).round(3).tolist()
NOISE = RNG.normal(10, 3, size=120).round(3).tolist()


def by_time(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("series_id", "ts").collect()]


def close(a, b):
    return all((x is None and y is None) or x == pytest.approx(y, abs=1e-9) for x, y in zip(a, b, strict=True))


def test_tiles_equal_whole_series(panel):
    df = panel({"a": WALK, "b": NOISE})
    w = Window.partitionBy("series_id").orderBy("ts")

    def columns(spec):
        return {"m": F.avg("value").over(spec.rowsBetween(-12, -1)), "n": F.lead("value", 5).over(spec)}

    tiled = over_tiles(df, columns, step=HOUR, back=12, ahead=5, tile_rows=34)
    whole = df.select("*", *[c.alias(n) for n, c in columns(w).items()])
    for c in ("m", "n"):
        assert close([r[0] for r in by_time(tiled, c)], [r[0] for r in by_time(whole, c)])


@pytest.mark.parametrize("tile_rows", [7, 50, 10_000])
def test_prefix_stats(panel, tile_rows):
    out = by_time(windows.prefix_stats(panel({"a": WALK}), HOUR, tile_rows=tile_rows), "prefix_mean", "prefix_var")
    assert out[0] == (None, None)
    for i in (1, 2, 60, 149):
        assert out[i][0] == pytest.approx(np.mean(WALK[:i]))
        assert out[i][1] == pytest.approx(np.var(WALK[:i]), abs=1e-9)


def test_features_do_not_see_the_present(panel):
    changed = [*WALK[:100], 1e6, *WALK[101:]]
    a = windows.feature_matrix(panel({"a": WALK}), HOUR, lags=[1, 24], windows=[3, 24]).drop("y")
    b = windows.feature_matrix(panel({"a": changed}), HOUR, lags=[1, 24], windows=[3, 24]).drop("y")
    limit = F.col("ts") <= F.lit("2024-01-05 04:00:00").cast("timestamp_ntz")
    assert sorted(a.where(limit).collect()) == sorted(b.where(limit).collect())
    assert a.count() == 150 - 24


def test_row_order_and_other_series_do_not_matter(spark, panel):
    df = panel({"a": WALK})
    rows = df.collect()
    random.Random(3).shuffle(rows)
    mixed = spark.createDataFrame(rows, df.schema).union(panel({"b": NOISE}))
    pick = F.col("series_id") == "a"
    one = windows.rolling_mean(df, 5, HOUR)
    two = windows.rolling_mean(mixed, 5, HOUR).where(pick)
    assert by_time(one, "ts", "rolling_mean") == by_time(two, "ts", "rolling_mean")


def test_runs_cross_tiles(panel):
    df = panel({"a": [1, 1, 1, 2, 2, 1, 1, 1, 1, 1, 3]})
    out = runs(df, F.col("value"), step=HOUR, tile_rows=2)
    assert sorted(r["count"] for r in out.groupBy("run").count().collect()) == [1, 2, 3, 5]


def test_decompose_adds_up(panel):
    for period in (6, 7):
        parts = stats.decompose(panel({"a": WALK, "short": [1, 2, 3]}), period, HOUR).collect()
        assert {r["series_id"] for r in parts} == {"a"}
        for r in parts:
            if r["trend"] is not None:
                assert r["trend"] + r["seasonal"] + r["resid"] == pytest.approx(r["value"])
        assert sum(r["trend"] is None for r in parts) == 2 * (period // 2)


def test_acf_pacf(panel):
    x = np.array(NOISE) - np.mean(NOISE)
    want = [float(x[k:] @ x[:-k] / (x @ x)) for k in range(1, 6)]
    rows = stats.acf(panel({"a": NOISE, "flat": [2.0] * 20}), 5, HOUR).collect()
    got = {r["lag"]: r["acf"] for r in rows if r["series_id"] == "a"}
    assert close([got[k] for k in range(1, 6)], want)
    assert all(r["acf"] is None for r in rows if r["series_id"] == "flat")
    partial = stats.partial_from_acf(want)
    for k in range(1, 6):  # the last coefficient of the Yule-Walker equations of each order
        r = [1.0, *want]
        matrix = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert partial[k - 1] == pytest.approx(np.linalg.solve(matrix, want[:k])[-1])


def test_quantiles_exact(panel):
    skewed = [float(i % 7) for i in range(500)] + [1e6]
    probs = [0.0, 0.025, 0.25, 0.5, 0.9, 1.0]
    rows = quantiles(panel({"a": skewed, "b": WALK, "one": [3], "flat": [2, 2]}), probs).collect()
    for sid, data in (("a", skewed), ("b", WALK), ("one", [3]), ("flat", [2, 2])):
        got = [r["quantile"] for r in sorted((r for r in rows if r["series_id"] == sid), key=lambda r: r["prob"])]
        assert got == pytest.approx(np.quantile(data, probs).tolist())


def test_ols_against_lstsq(spark):
    x = RNG.normal(size=(80, 3)) * [1, 1000, 0.01] + [0, 5000, 1]
    y = 2 + x @ [1.5, -0.002, 40] + RNG.normal(size=80) * 0.1
    df = spark.createDataFrame([("g", *map(float, r), float(t)) for r, t in zip(x, y)], "series_id string, a double, b double, c double, y double")
    fit = ols_fit(df, ["a", "b", "c"], "y").collect()[0]
    design = np.column_stack([np.ones(80), x])
    beta, sse, *_ = np.linalg.lstsq(design, y, rcond=None)
    assert fit["beta"] == pytest.approx(beta.tolist(), rel=1e-6)
    assert fit["sse"] == pytest.approx(float(sse[0]), rel=1e-6)


def test_adf_against_lstsq(panel):
    def regression(v, lags, skip):
        d = np.diff(v)
        rows = range(max(lags, skip), len(d))
        design = np.array([[1.0, v[t], *[d[t - k] for k in range(1, lags + 1)]] for t in rows])
        y = d[list(rows)]
        beta, *_ = np.linalg.lstsq(design, y, rcond=None)
        sse = float(((y - design @ beta) ** 2).sum())
        cov = np.linalg.inv(design.T @ design) * sse / (len(y) - lags - 2)
        return beta[1] / cov[1, 1] ** 0.5, len(y) * np.log(sse / len(y)) + 2 * (lags + 2), len(y)

    v = np.array(WALK)
    best = min(range(4), key=lambda k: regression(v, k, 3)[1])
    want, _, n = regression(v, best, 0)
    got = stats.adf_test(panel({"a": WALK}), HOUR, maxlag=3).collect()[0]
    assert (got["lags"], got["n"]) == (best, n)
    assert got["adf"] == pytest.approx(want, rel=1e-6)
    assert 0 < got["p_value"] < 1 and got["crit_1"] < got["crit_5"] < got["crit_10"]


def test_normal_functions(spark):
    ps = [1e-6, 0.01, 0.2, 0.5, 0.77, 0.999]
    df = spark.createDataFrame([(p,) for p in ps], "p double").withColumn("z", normal_quantile(F.col("p")))
    for r in df.withColumn("back", normal_cdf(F.col("z"))).collect():
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=2e-6)
        assert r["back"] == pytest.approx(r["p"], abs=2e-7)


def test_box_cox(spark):
    df = spark.createDataFrame([(4.0,), (0.0,), (-1.0,)], "v double")
    for lam in (0.4, 0):
        out = [r["b"] for r in df.select(inv_box_cox(box_cox(F.col("v"), lam), lam).alias("b")).collect()]
        assert out == [pytest.approx(4.0), None, None]


def test_constant_series_have_no_anomalies(panel):
    df = panel({"flat": [5.0] * 30, "one": [1.0]})
    assert stats.zscore(df).where("zscore IS NOT NULL").count() == 0
    assert anomaly.detect_all(df, HOUR, period=4).count() == 0
    assert anomaly.moving_average_band(df, 4, HOUR).where("is_anomaly").count() == 0


def test_stuck_and_outage(panel):
    df = panel({"a": [1, 2, 2, 2, 2, 3, 0, 0, 4]})
    run = anomaly.stuck_sensor(df, HOUR, min_run=3).collect()
    assert [(r["n_steps"], r["value"]) for r in run] == [(4, 2.0)]
    down = anomaly.outages(df.withColumn("yhat", F.lit(5.0)), HOUR, eps=0.5, k=1.0).collect()
    assert [(r["n_steps"], (r["end_ts"] - r["start_ts"]).seconds) for r in down] == [(2, 7200)]


def test_days_hold_no_table_of_their_tiles(spark):
    """Rows sorted by tile are added up along that order, and a day that is one tile needs no further aggregate."""
    rows = [(s, datetime(2024, 1, 1, 12) + timedelta(hours=h), v) for s, h, v in [("a", 0, 1.0), ("a", 3, 4.0), ("a", 24, 0.0), ("a", 30, None), ("a", 80, 5.0), ("b", 1, 2.0), (None, 2, 3.0)]]
    df = spark.createDataFrame([*rows, ("c", None, 7.0)], "series_id string, ts timestamp_ntz, value double")
    days = daily.daily_metrics(df)
    assert "HashAggregate" not in days._jdf.queryExecution().executedPlan().toString()
    by_hours = daily.daily_metrics(df, tile_seconds=3600)
    key = lambda r: (str(r["series_id"]), str(r["date"]))
    left, right = sorted(days.collect(), key=key), sorted(by_hours.collect(), key=key)
    assert len(left) == len(right) == 6
    for p, q in zip(left, right):
        for name in days.columns:
            assert p[name] == (pytest.approx(q[name]) if isinstance(q[name], float) else q[name]), (name, p, q)
