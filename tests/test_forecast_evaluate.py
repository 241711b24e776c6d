from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import evaluate
from panelcast.operators.forecast import arima, baseline, forest, pooled, smoothing, structural, var
from panelcast.operators.forecast.contract import check_contract, to_contract
from panelcast.operators.windows import feature_matrix
from panelcast.plans.grid import DAY, HOUR, MONTH

RNG = np.random.default_rng(11)
SEASON = (100 + np.arange(60) * 0.5 + 10 * np.sin(np.arange(60) * np.pi / 6) + RNG.normal(size=60)).round(3)
NOISE = RNG.normal(50, 5, size=70).round(3)


def path(df, sid="a"):
    return [r["yhat"] for r in df.where(F.col("series_id") == sid).orderBy("h").collect()]


def seasonal_by_hand(y, p, kind, a, b, g):
    """Textbook Holt-Winters, one parameter set, plain loops."""
    level = sum(y[:p]) / p
    trend = (sum(y[p : 2 * p]) / p - level) / p
    season = [v - level if kind == "add" else v / level for v in y[:p]]
    sse = 0.0
    for t in range(p, len(y)):
        s = season[t % p]
        guess = level + trend + s if kind == "add" else (level + trend) * s
        sse += (y[t] - guess) ** 2
        old_level, old_trend = level, trend
        known = y[t] - s if kind == "add" else y[t] / s
        level = a * known + (1 - a) * (old_level + old_trend)
        trend = b * (level - old_level) + (1 - b) * old_trend
        fresh = y[t] - old_level - old_trend if kind == "add" else y[t] / (old_level + old_trend)
        season[t % p] = g * fresh + (1 - g) * s
    return level, trend, season, sse


@pytest.mark.parametrize("kind", ["add", "mul"])
def test_seasonal_smoothing_by_hand(panel, kind):
    y, p, h = SEASON.tolist(), 12, 14
    best = min(product(smoothing.SEASONAL_GRID, repeat=3), key=lambda q: (seasonal_by_hand(y, p, kind, *q)[3], q))
    around = [sorted({min(max(round(c + d, 2), 0.0), 1.0) for d in smoothing.REFINE}) for c in best]
    best = min(product(*around), key=lambda q: (seasonal_by_hand(y, p, kind, *q)[3], q))
    level, trend, season, sse = seasonal_by_hand(y, p, kind, *best)
    want = []
    for k in range(1, h + 1):
        s = season[(len(y) + k - 1) % p]
        want.append(level + k * trend + s if kind == "add" else (level + k * trend) * s)
    df = panel({"a": y, "short": y[:20], "gap": [None, *y]}, months=True)
    fit = smoothing.fit_smoothing(df, kind, h, period=p).collect()
    assert [r["series_id"] for r in fit] == ["a"]
    assert (fit[0]["alpha"], fit[0]["beta"], fit[0]["gamma"]) == pytest.approx(best)
    assert fit[0]["sse"] == pytest.approx(sse)
    assert fit[0]["yhat"] == pytest.approx(want)


def test_multiplicative_needs_positive_values(panel):
    df = panel({"a": [0.0, *SEASON]}, months=True)
    assert smoothing.forecast_hw_mul(df, 3, MONTH).count() == 0
    assert [r["status"] for r in evaluate.forecast_status(df, ["hw_mul"]).collect()] == ["not_positive"]


def test_status_names_every_series(panel):
    y = SEASON.tolist()
    df = panel({"whole": y, "gap": [*y[:30], None, *y[31:]], "short": y[:20], "zero": [*y[:-1], 0.0]}, months=True)
    status = {(r["series_id"], r["model"]): r["status"] for r in evaluate.forecast_status(df).collect()}
    assert len(status) == 4 * len(evaluate.MODELS)
    assert status["gap", "ses"] == "has_gaps" and status["gap", "naive"] == "ok"
    assert status["short", "hw_add"] == "too_short" and status["short", "holt"] == "ok"
    assert status["zero", "hw_mul"] == "not_positive" and status["zero", "hw_add"] == "ok"
    # The status says which series have a forecast.
    for model in evaluate.MODELS:
        have = {r["series_id"] for r in evaluate.run_model(df, 2, MONTH, model=model).select("series_id").collect()}
        assert have == {s for (s, m), x in status.items() if m == model and x == "ok"}


def test_folds_keep_every_test_row(panel):
    """A test part of n // 6 rows is scored to its end, whatever n."""
    df = panel({s: list(range(100)) for s in "abc"}, seconds=DAY)
    folds = evaluate.expanding_folds(df, 2, step=DAY)
    rows = evaluate.evaluate_folds(folds, baseline.forecast_mean, None, DAY, model="mean")
    assert rows.count() == rows.where("forecast IS NOT NULL").count() == 3 * 2 * 33
    few = evaluate.metrics(evaluate.evaluate_folds(folds, baseline.forecast_mean, 14, DAY, model="mean")).collect()[0]
    assert (few["n"], few["n_missing"]) == (3 * 2 * 14, 3 * 2 * 19)


def test_models_compete_on_the_same_rows(panel):
    rng = np.random.default_rng(1)
    y = (50 + rng.normal(size=60)).tolist()
    df = panel({"whole": y, "gap": [*y[:10], None, *y[11:]], "zero": [0.0, *y[1:]]}, months=True)
    rows = evaluate.compare_models(df, MONTH, models=["naive", "ses", "hw_mul"])
    assert rows.count() == 3 * 3 * 3 * 12
    board = {r["model"]: r for r in evaluate.leaderboard(rows).collect()}
    assert {m: r["n_missing"] for m, r in board.items()} == {"naive": 0, "ses": 36, "hw_mul": 72}
    assert {r["n_fits"] for r in board.values()} == {3}  # the folds of the one series all of them know
    best = {r["series_id"]: r["model"] for r in evaluate.best_model_per_series(rows).collect()}
    assert best["gap"] == "naive" and best["zero"] in ("naive", "ses")


def test_rolling_origin_states_what_it_needs(panel):
    with pytest.raises(ValueError, match="24 points"):
        evaluate.rolling_origin(panel({"a": SEASON.tolist()}, months=True), "mul", MONTH, train_size=20)


def test_rolling_origin_is_refitting(panel):
    """One pass over the series gives what a fit per origin gives."""
    y = SEASON.tolist()
    rows = evaluate.rolling_origin(panel({"a": y}, months=True), "mul", MONTH, train_size=50, max_horizon=3).collect()
    assert len(rows) == (60 - 3 - 50 + 1) * 3
    got = {(r["origin_ts"], r["horizon"]): r for r in rows}
    for n in (50, 54, 57):
        part = panel({"a": y[:n]}, months=True)
        alone = smoothing.forecast_hw_mul(part, 3, MONTH).orderBy("h").collect()
        for r in alone:
            row = got[r["origin_ts"], r["h"]]
            assert row["forecast"] == pytest.approx(r["yhat"])
            assert row["ts"] == r["ts"]
            assert row["actual"] == y[n + r["h"] - 1]


def test_baselines(panel):
    df = panel({"a": [1, 2, 3, 4, 5], "b": [7, 9]}, seconds=DAY)
    assert path(baseline.forecast_mean(df, 2, DAY)) == [3, 3]
    assert path(baseline.forecast_naive(df, 2, DAY)) == [5, 5]
    assert path(baseline.forecast_snaive(df, 4, DAY, season=3)) == [3, 4, 5, 3]
    assert path(baseline.forecast_snaive(df, 3, DAY, season=3), "b") == [7, 9, 7]


def test_ar_and_arima_by_hand(panel):
    y = NOISE
    df = panel({"a": y.tolist(), "tiny": [1, 2, 3]}, seconds=DAY)
    x = np.column_stack([np.ones(68), y[1:-1], y[:-2]])
    beta = np.linalg.lstsq(x, y[2:], rcond=None)[0]
    v = list(y)
    for _ in range(4):
        v.append(beta @ [1, v[-1], v[-2]])
    out = arima.forecast_arima(df, 4, DAY, order=(2, 0, 0))
    assert path(out) == pytest.approx(v[-4:])
    assert path(out, "tiny") == []
    # Differencing: a straight line goes on.
    line = panel({"a": [3.0 * i for i in range(40)]}, seconds=DAY)
    assert path(arima.forecast_arima(line, 3, DAY, order=(1, 1, 0))) == pytest.approx([120, 123, 126])
    season = panel({"a": [float(i % 12) for i in range(60)]}, months=True)
    out = arima.forecast_sarima(season, 13, MONTH, order=(0, 0, 0), seasonal=(0, 1, 0, 12))
    assert path(out) == pytest.approx([float(i % 12) for i in range(13)])


def test_moving_average_terms(panel):
    e = RNG.normal(size=4000)
    y = e[1:] + 0.6 * e[:-1]
    fit = arima.fit_terms(y, arima.Terms.of((0, 0, 1)))
    assert fit.beta[1] == pytest.approx(0.6, abs=0.05)
    rows = arima.arima_residuals(panel({"a": y[:300].round(4).tolist()}), (1, 0, 1)).where("resid IS NOT NULL")
    assert rows.count() > 280


def test_innovations_are_the_models_own(panel):
    """The recursion starts from the errors that the fitted coefficients make."""
    e = RNG.normal(size=400)
    y = e[1:] + 0.5 * e[:-1]
    terms = arima.Terms.of((1, 0, 1))
    fit = arima.fit_terms(y, terms)
    c, phi, theta = fit.beta
    last = 0.0
    for t in range(1, len(y)):
        last = y[t] - c - phi * y[t - 1] - theta * last
    assert fit.shocks[-1] == pytest.approx(last)
    path, _ = arima.extend_series(y, fit, terms, 1)
    assert path[0] == pytest.approx(c + phi * y[-1] + theta * last)


def test_seasonal_lags_are_those_of_the_product():
    terms = arima.Terms.of((1, 0, 1), (1, 1, 1, 12))
    assert terms.ar == (1, 12, 13) and terms.ma == (1, 12, 13)
    for order, seasonal in [((1, 1, 1), arima.FLAT), ((1, 0, 1), (1, 1, 1, 12)), ((0, 2, 1), (0, 1, 1, 4)), ((2, 0, 0), arima.FLAT)]:
        t = arima.Terms.of(order, seasonal)
        assert [n for n in range(1, 90) if arima.fit_terms(RNG.normal(size=n), t) is not None] == list(range(t.points_needed, 90))


def test_order_search_ranks_all(panel):
    orders = [((1, 0, 0), arima.FLAT), ((0, 1, 0), arima.FLAT), ((1, 0, 1), arima.FLAT)]
    rows = arima.order_search(panel({"a": NOISE.tolist()}), 10, orders).collect()
    assert sorted(r["rank"] for r in rows) == [1, 2, 3]
    drift = [r["rmse"] for r in rows if r["trial"] == 1][0]
    assert drift == pytest.approx(float(np.sqrt(np.mean((NOISE[-10:] - NOISE[-11]) ** 2))))


def test_best_order_is_the_searched_one(panel):
    orders = [((1, 0, 0), arima.FLAT), ((0, 1, 0), arima.FLAT), ((1, 0, 1), arima.FLAT)]
    df = panel({"a": NOISE.tolist(), "short": [1.0] * 9, "gap": [1.0] * 30 + [None] + [2.0] * 30})
    best = [r["params"] for r in arima.order_search(df, 10, orders).where("rank = 1 AND series_id = 'a'").collect()][0]
    rows = arima.forecast_best_order(df, 4, HOUR, orders=orders, n_test=10).orderBy("h").collect()
    assert {(r["series_id"], r["params"]) for r in rows} == {("a", best)}
    plain = arima.forecast_sarima(df.where("series_id = 'a'"), 4, HOUR, order=dict((str(o), o) for o in orders)[best][0])
    assert [r["yhat"] for r in rows] == pytest.approx(path(plain))
    up = panel({"a": np.exp(0.1 * np.arange(40)).tolist()})
    grown = arima.forecast_best_order(up, 3, HOUR, orders=[((0, 1, 0), arima.FLAT), ((1, 1, 0), arima.FLAT)], n_test=5, box_cox=0)
    assert [r["yhat"] for r in grown.orderBy("h").collect()] == pytest.approx(np.exp(0.1 * np.arange(40, 43)).tolist(), rel=1e-6)


def test_var_by_hand(panel):
    a, b = RNG.normal(size=50).cumsum().round(4), RNG.normal(size=50).round(4)
    y = np.column_stack([a, b])
    x = np.column_stack([np.ones(48), y[1:-1], y[:-2]])
    beta = np.linalg.lstsq(x, y[2:], rcond=None)[0].T
    rows = list(y)
    for _ in range(3):
        rows.append(beta @ np.concatenate([[1], rows[-1], rows[-2]]))
    out = var.forecast_var(panel({"a": a.tolist(), "b": b.tolist()}, seconds=DAY), ["a", "b"], 3, DAY)
    assert path(out) == pytest.approx([r[0] for r in rows[50:]])
    assert path(out, "b") == pytest.approx([r[1] for r in rows[50:]])


def test_varma_by_hand(panel):
    """Two stages: errors of a longer autoregression as regressors, then the model's own errors to its end."""
    n = 90
    a, b = RNG.normal(size=n).cumsum().round(4), RNG.normal(size=n).round(4)
    y = np.column_stack([a, b])

    def design(lags, shocks=None):
        start = 6 if shocks is None else 7
        x = [np.ones(n - start), *[y[start - k : n - k] for k in range(1, lags + 1)]]
        return np.column_stack(x + ([] if shocks is None else [shocks[start - 1 : n - 1]])), y[start:]

    x, z = design(6)
    shocks = np.vstack([np.full((6, 2), np.nan), z - x @ np.linalg.lstsq(x, z, rcond=None)[0]])
    x, z = design(2, shocks)
    beta = np.linalg.lstsq(x, z, rcond=None)[0].T
    rows, e = list(y), [np.zeros(2)] * 2
    for t in range(2, n):
        e.append(y[t] - beta @ np.concatenate([[1], y[t - 1], y[t - 2], e[t - 1]]))
    for _ in range(3):
        rows.append(beta @ np.concatenate([[1], rows[-1], rows[-2], e[-1]]))
        e.append(np.zeros(2))
    out = var.forecast_var(panel({"a": a.tolist(), "b": b.tolist()}, seconds=DAY), ["a", "b"], 3, DAY, q=1)
    assert path(out) == pytest.approx([r[0] for r in rows[n:]])
    assert path(out, "b") == pytest.approx([r[1] for r in rows[n:]])


def test_structural_against_dense_ridge(panel):
    days = np.arange(400)
    y = (5 + 0.02 * days + 2 * np.sin(2 * np.pi * days / 7) + RNG.normal(size=400) * 0.1).round(4)
    df = panel({"a": y.tolist()}, seconds=DAY)
    holidays = [("2024-12-25", "x"), ("2024-02-01", "x")]
    out = structural.forecast_structural(df, 14, DAY, holidays=holidays)
    design = structural.Design(DAY, holidays=tuple(holidays))
    first = np.datetime64("2024-01-01")
    ts = (first + np.arange(414)).astype("datetime64[ns]")
    index = np.arange(414, dtype=float)
    x = design.matrix(ts, index, 0.0, 399.0)
    scale = np.abs(y).max()
    beta = np.linalg.solve(x[:400].T @ x[:400] + np.diag(design.ridge()), x[:400].T @ (y / scale))
    assert path(out) == pytest.approx((x[400:] @ beta * scale).tolist(), abs=1e-5)
    future = 5 + 0.02 * np.arange(400, 414) + 2 * np.sin(2 * np.pi * np.arange(400, 414) / 7)
    assert np.abs(np.array(path(out)) - future).mean() < 0.3


def test_structural_groups_and_tuning(panel):
    y = (5 + 0.3 * np.arange(72) + RNG.normal(size=72)).round(3).tolist()
    df = panel({"a": y, "b": y[:60], "tiny": y[:3], "none": [None] * 4}, months=True)
    whole = structural.forecast_structural(df, 3, MONTH)
    folds = df.withColumn("fold", F.lit(7)).unionByName(df.limit(0).withColumn("fold", F.lit(8)))
    keyed = structural.forecast_structural(folds, 3, MONTH, keys=["series_id", "fold"])
    assert sorted(keyed.drop("fold").collect()) == sorted(whole.collect()) and whole.count() == 9
    rows = evaluate.cutoff_cv(df, structural.forecast_structural, None, MONTH, model="s")
    assert rows.count() == rows.where("forecast IS NOT NULL").count() > 0
    best, scores = evaluate.grid_search_structural(df, MONTH)
    table = {(r["series_id"], r["trial"]): r["mse"] for r in scores.collect()}
    assert {r["series_id"]: r["trial"] for r in best.collect()} == {s: min((0, 1), key=lambda i: table[s, i]) for s, _ in table}
    assert evaluate.forecast_tuned_structural(df, 3, MONTH).count() == 9


def test_forest(spark, panel, tmp_path):
    hours = np.arange(300)
    y = (10 + 5 * np.sin(2 * np.pi * hours / 24) + RNG.normal(size=300) * 0.2).round(4)
    df = panel({"a": y.tolist(), "b": (y * 2).tolist(), "short": [1.0] * 5})
    lags, sizes = [1, 24], [3, 24]
    rows = feature_matrix(df, HOUR, lags=lags, windows=sizes)
    model = forest.fit_random_forest(rows, n_trees=5, max_depth=4)
    flat = forest.flatten_trees(spark, model)
    names = forest.feature_names(rows)
    for r in model.transform(rows).limit(50).collect():
        votes = flat.predict(np.array([[float(r[n]) for n in names]]))[0]
        assert votes.mean() == pytest.approx(r["prediction"])
    out = forest.forecast_recursive(df, model, 24, HOUR, lags=lags, windows=sizes)
    assert out.count() == 48
    assert out.where("lower > upper").count() == 0
    first = out.where("h = 1 AND series_id = 'a'").collect()[0]
    x = np.array([y[-1], y[-24], y[-3:].mean(), y[-24:].mean(), 300 % 24, (300 // 24) % 7], dtype=float)
    assert first["yhat"] == pytest.approx(flat.predict(x[None, :]).mean())
    inside = forest.forest_interval(model, rows)
    assert inside.where("lower > upper").count() == 0
    best, table = forest.grid_search_forest(rows, [{"n_trees": 3, "max_depth": d} for d in (1, 4)])
    assert best["max_depth"] == 4 and table.count() == 2


def test_contract(panel):
    made = to_contract(baseline.forecast_naive(panel({"a": [3, 2, 1]}), 2, HOUR), "naive")
    assert check_contract(made).where("lower > upper").count() == 0
    with pytest.raises(TypeError):
        check_contract(made.drop("upper"))


def test_quantile_forecast_follows_the_clock(panel):
    y = [float(i % 24) for i in range(24 * 14)]
    assert path(baseline.forecast_quantile(panel({"a": y}), 24, HOUR)) == [float(i) for i in range(24)]


def test_rolling_alignment(panel):
    y = [float(i * i) for i in range(20)]
    df = panel({"a": y})
    for model, guess in {
        "naive": lambda t, h: y[t - 1],
        "mean": lambda t, h: sum(y[:t]) / t,
        "snaive": lambda t, h: y[t - 3 + (h - 1) % 3],
    }.items():
        rows = evaluate.rolling_origin(df, model, HOUR, train_size=10, max_horizon=4, season=3).collect()
        assert len(rows) == (20 - 4 - 10 + 1) * 4
        for r in rows:
            t = int((r["origin_ts"] - df.first()["ts"]).total_seconds() // 3600) + 1
            assert r["actual"] == y[t + r["horizon"] - 1]
            assert r["forecast"] == pytest.approx(guess(t, r["horizon"]))


def test_folds(panel):
    folds = evaluate.expanding_folds(panel({"a": list(range(13))}), 3)
    by = {(r["fold"], r["part"]): r["n"] for r in folds.groupBy("fold", "part").agg(F.count("*").alias("n")).collect()}
    assert by == {(1, "train"): 4, (1, "test"): 3, (2, "train"): 7, (2, "test"): 3, (3, "train"): 10, (3, "test"): 3}
    same = evaluate.expanding_folds(panel({"a": list(range(13))}), 3, step=HOUR)
    assert sorted(same.select(*folds.columns).collect()) == sorted(folds.collect())


def test_metrics(spark, panel):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 3.0)], "actual double, forecast double")
    row = evaluate.metrics(df).collect()[0]
    assert (row["n"], row["mse"], row["mae"], row["mape"], row["n_mape"]) == (2, 5.0, 2.0, 50.0, 1)
    filled = evaluate.metrics_filled(panel({"a": [1, None, 3]}), panel({"a": [1, 1, None]}), HOUR).collect()[0]
    assert filled["mae"] == pytest.approx(2 / 3)
    with pytest.raises(Exception, match="one side only"):
        evaluate.metrics_filled(panel({"a": [1, 2, 3]}), panel({"a": [1, 2]}), HOUR).collect()


def test_cutoffs(panel):
    df = panel({"a": list(range(60))}, months=True)
    cuts = sorted(str(r["cutoff"].date()) for r in evaluate.yearly_cutoffs(df).collect())
    assert cuts == ["2026-01-31", "2027-01-31"]


def test_grid_search_picks_the_least(panel):
    best, scores = evaluate.grid_search_smoothing(panel({"a": NOISE.tolist()}), "ses", n_test=10)
    rows = scores.collect()
    assert len(rows) == 19
    assert best.collect()[0]["rmse"] == min(r["rmse"] for r in rows)


@pytest.mark.parametrize("order,seasonal", [((1, 0, 0), (0, 0, 0, 0)), ((2, 1, 0), (0, 0, 0, 0)), ((1, 0, 0), (1, 1, 0, 12)), ((0, 0, 0), (0, 0, 0, 0)), ((0, 1, 0), (0, 0, 0, 0))])
@pytest.mark.parametrize("tile_rows", [65_536, 1])
def test_carried_fits_are_refits(panel, order, seasonal, tile_rows):
    """Normal equations carried over tiles give what a fit on each training set gives."""
    rng = np.random.default_rng(5)
    series = {k: (100 + np.cumsum(rng.normal(0, 1, 90)) + 8 * np.sin(np.arange(90) * np.pi / 6)).tolist() for k in "ab"}
    from panelcast.operators.forecast.carried import carried_forecasts, rolling_origins

    rows = carried_forecasts(panel(series, months=True), MONTH, rolling_origins(45, 3), 3, order=order, seasonal=seasonal, tile_rows=tile_rows).collect()
    assert len(rows) == 2 * 3 * (90 - 3 - 45 + 1)
    terms = arima.Terms.of(order, seasonal)
    for r in rows:
        y = np.array(series[r["series_id"]])
        train = y[: r["n_train"]]
        fit = arima.fit_terms(train, terms)
        assert r["forecast"] == pytest.approx(arima.extend_series(train, fit, terms, 3)[0][r["horizon"] - 1], rel=1e-7)
        assert r["actual"] == y[r["n_train"] + r["horizon"] - 1]


def test_carried_folds_keep_every_test_row(panel):
    y = [float(i % 7) + 0.1 * i for i in range(60)]
    gap = [*y[:20], None, *y[21:]]
    rows = evaluate.expanding_autoregression(panel({"a": y, "gap": gap, "few": y[:6]}), HOUR, 3, order=(1, 0, 0)).collect()
    by = {}
    for r in rows:
        by.setdefault((r["series_id"], r["fold"]), []).append(r["forecast"])
    assert {k: len(v) for k, v in by.items()} == {(s, f): n for s, n in (("a", 15), ("gap", 15), ("few", 1)) for f in (1, 2, 3)}
    assert all(x is not None for f in (1, 2, 3) for x in by["a", f])
    assert all(x is not None for x in by["gap", 1]) and all(x is None for f in (2, 3) for x in by["gap", f])
    assert by["few", 1] == [None]  # three rows hold two regressions rows, as many as coefficients
    status = {(r["series_id"], r["fold"]): (r["n_train"], r["n_test"], r["status"]) for r in evaluate.fold_status(panel({"a": y, "few": y[:2]}), 3).collect()}
    assert status["a", 1] == (15, 15, "ok") and status["few", 3] == (2, 0, "too_short")


def test_models_that_cannot_be_rolled_are_refused(panel):
    df = panel({"a": SEASON.tolist()}, months=True)
    with pytest.raises(ValueError, match="unknown model"):
        evaluate.rolling_origin(df, "prophet", MONTH)
    with pytest.raises(ValueError, match="moving-average"):
        evaluate.rolling_origin(df, "arima", MONTH, order=(1, 1, 1))


def test_best_model_keeps_series_without_any(panel):
    from panelcast.operators.forecast.baseline import forecast_naive

    df = panel({"a": SEASON.tolist(), "b": [None] * 60}, months=True)
    rows = evaluate.evaluate_folds(evaluate.expanding_folds(df, 2, test_size=6, step=MONTH), forecast_naive, 6, MONTH, model="naive")
    assert {r["series_id"]: r["model"] for r in evaluate.best_model_per_series(rows).collect()} == {"a": "naive", "b": None}


def test_quantile_regression(spark, panel):
    """Minimal pinball loss, levels in order, and about the right share of later rows inside."""
    from panelcast.operators.forecast import quantile

    rng = np.random.default_rng(2)
    t = np.arange(24 * 7 * 20)
    spread = 2 + 1.5 * np.sin(2 * np.pi * t / 24)
    y = 10 + 5 * np.cos(2 * np.pi * t / 24) + spread * rng.exponential(1, len(t))
    cut = 24 * 7 * 14
    probs = [0.1, 0.5, 0.9]
    fit = quantile.fit_quantile_regression(panel({"a": y[:cut].tolist(), "flat": [3.0] * 200, "none": [None] * 5}), probs)
    balance = quantile.pinball_balance(panel({"a": y[:cut].tolist()}), probs, fit).collect()
    assert len(balance) == 3 and all(r["is_minimum"] for r in balance)
    later = quantile.predict_quantiles(panel({"a": y.tolist()}), fit).orderBy("ts").collect()[cut:]
    q = np.array([r["q"] for r in later])
    assert (np.diff(q, axis=1) >= 0).all()
    assert np.abs((y[cut:, None] <= q).mean(axis=0) - probs).max() <= 0.03
    inside = ((y[cut:] >= q[:, 0]) & (y[cut:] <= q[:, 2])).mean()
    assert abs(inside - 0.8) <= 0.03
    flat = quantile.predict_quantiles(panel({"flat": [3.0] * 3}), fit).first()["q"]
    assert flat == pytest.approx([3.0] * 3, abs=1e-3)
    made = quantile.forecast_quantile_regression(panel({"a": y[:cut].tolist()}), 24, HOUR).orderBy("h").collect()
    assert len(made) == 24 and all(r["lower"] <= r["yhat"] <= r["upper"] for r in made)


def test_models_over_all_series_compete(panel):
    """Weekly shapes of very different size: each model over all series follows them, a constant forecast can't."""
    rng = np.random.default_rng(5)
    phase = 2 * np.pi * np.arange(7) / 7
    week = 3 * np.sin(phase) + np.cos(2 * phase)  # the regression knows two harmonics of the week
    rows = {s: (size * (10 + np.tile(week, 30) + 0.2 * rng.normal(size=210))).tolist() for s, size in (("a", 1.0), ("b", 100.0), ("c", 1e4))}
    df = panel(rows, seconds=DAY)
    models = ["mean", "naive", "forest", "gbt", "quantile"]  # two lags of a system hold no week: see below
    made = evaluate.compare_models(df, DAY, folds=1, horizon=7, models=models).collect()
    assert len(made) == 3 * 7 * 5
    mape = {m: np.mean([abs(r["error"] / r["actual"]) for r in made if r["model"] == m]) for m in models}
    assert max(mape[m] for m in models[2:]) < 0.25 * min(mape["mean"], mape["naive"]), mape


def test_a_fold_knows_nothing_of_what_comes_after(panel):
    y = np.random.default_rng(6).normal(size=60).tolist()
    first = lambda x: sorted((r["ts"], r["forecast"]) for r in evaluate.compare_models(panel({"a": x}), HOUR, folds=2, horizon=3, models=["forest"]).where("fold = 1").collect())
    assert first(y) == first([*y[:-6], *[99.0] * 6])


def test_a_system_sees_what_another_series_announces(panel):
    """b repeats a a step later: only the model of both knows its next value."""
    a = np.random.default_rng(9).normal(size=121)
    df = panel({"a": a[1:].tolist(), "b": (5 + a[:-1]).tolist()})
    made = evaluate.compare_models(df, 3600, folds=4, horizon=1, models=["mean", "naive", "var"])
    mae = {r["model"]: r["mae"] for r in evaluate.metrics(made.where("series_id = 'b'"), ["model"]).collect()}
    assert mae["var"] < 1e-6 < 0.05 < min(mae["mean"], mae["naive"])


def test_boosted_trees_step_by_step(spark, panel):
    """Flat trees with their weights say what the library's model says."""
    rng = np.random.default_rng(8)
    df = panel({"a": rng.normal(size=200).cumsum().tolist()})
    lags, windows = pooled.lag_set(3600)
    features = feature_matrix(df, 3600, lags=lags, windows=windows)
    model = forest.fit_gbt(features, n_trees=5, max_depth=3)
    ahead = forest.forecast_recursive(df, model, 1, 3600, lags=lags, windows=windows).collect()[0]
    assert ahead["lower"] is None and ahead["upper"] is None
    longer = df.unionByName(spark.createDataFrame([("a", ahead["ts"], 0.0)], df.schema))
    want = forest.predict(model, feature_matrix(longer, 3600, lags=lags, windows=windows)).where(F.col("ts") == ahead["ts"]).collect()[0]["yhat"]
    assert ahead["yhat"] == pytest.approx(want)


def test_pooled_models_say_what_they_cannot(panel):
    short = panel({"a": [1.0, 2.0, 3.0], "b": [2.0, 2.0, 2.0]}, seconds=DAY)
    assert pooled.forecast_pooled(short, 3, DAY, model="forest").count() == 0
    with pytest.raises(ValueError, match="12 series"):
        pooled.forecast_pooled(panel({str(i): [1.0, 2.0] for i in range(13)}), 2, 3600, model="var")
    with pytest.raises(ValueError, match="fixed length"):
        pooled.forecast_pooled(panel({"a": [1.0] * 30}, months=True), 2, MONTH, model="gbt")
    with pytest.raises(ValueError, match="unknown model"):
        evaluate.run_model(short, 2, DAY, model="none such")
