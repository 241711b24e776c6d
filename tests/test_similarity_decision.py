from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import anomaly, decision, profile, similarity
from panelcast.plans.grid import HOUR

RNG = np.random.default_rng(5)


def warp_by_hand(p, q, band=None):
    n, m = len(p), len(q)
    reach = n + m if band is None else max(band, abs(n - m))
    cost = np.full((n + 1, m + 1), np.inf)
    cost[0, 0] = 0
    for i in range(n):
        for j in range(m):
            if abs(i - j) <= reach:
                cost[i + 1, j + 1] = (p[i] - q[j]) ** 2 + min(cost[i, j], cost[i, j + 1], cost[i + 1, j])
    return float(np.sqrt(cost[n, m]))


@pytest.fixture(scope="module")
def points(spark):
    data = {f"s{i:02d}": RNG.normal(size=8 if i % 5 else 6).round(3).tolist() for i in range(24)}
    rows = [(k, v, "even" if int(k[1:]) % 2 == 0 else "odd") for k, v in data.items()]
    return data, spark.createDataFrame(rows, "series_id string, points array<double>, category string")


@pytest.mark.parametrize("band", [None, 2])
def test_all_pairs(points, band):
    data, df = points
    rows = similarity.dtw_matrix(df, blocks=3, band=band).collect()
    assert len(rows) == 24 * 23 // 2
    for r in rows:
        assert r["id_a"] < r["id_b"]
        assert r["distance"] == pytest.approx(warp_by_hand(data[r["id_a"]], data[r["id_b"]], band))


@pytest.mark.parametrize("within", [[], ["category"]])
def test_radius_join_is_complete(points, within):
    data, df = points
    ids = sorted(data)
    want = {
        (a, b)
        for a in ids
        for b in ids
        if a < b
        and (not within or int(a[1:]) % 2 == int(b[1:]) % 2)
        and warp_by_hand(data[a], data[b]) <= 1.5
    }
    got = {(r["id_a"], r["id_b"]) for r in similarity.dtw_within(df, 1.5, within=within).collect()}
    assert got == want and want


def test_path(spark):
    df = spark.createDataFrame([([0.0, 1.0, 2.0], [0.0, 0.0, 1.0, 2.0])], "points_a array<double>, points_b array<double>")
    steps = [(s["i"], s["j"]) for s in similarity.dtw_path(df).collect()[0]["path"]]
    assert steps == [(0, 0), (0, 1), (1, 2), (2, 3)]
    d = df.select(similarity.dtw_distance(F.col("points_a"), F.col("points_b")).alias("d")).collect()[0]["d"]
    assert d == 0


def test_clusters_separate(spark):
    rows = []
    for i in range(30):
        base = np.sin(np.arange(20) / 3) * (1, 5, 25)[i % 3] + (0, 50, -50)[i % 3]
        rows.append((f"s{i}", (base + RNG.normal(size=20) * 0.1).tolist(), i % 3))
    df = spark.createDataFrame(rows, "series_id string, points array<double>, truth int")
    found = similarity.dtw_cluster(df.drop("truth"), k=3).join(df, "series_id")
    assert found.count() == 30
    assert found.where("distance IS NULL").count() == 0


def test_correlation_with_gaps(panel):
    data = {f"s{i}": RNG.normal(size=40).round(3).tolist() for i in range(7)}
    data["s1"][3] = None
    data["s4"][10] = None
    rows = similarity.correlation_matrix(panel(data), HOUR, blocks=3).collect()
    assert len(rows) == 21
    for r in rows:
        a, b = (np.array(data[r[k]], dtype=float) for k in ("id_a", "id_b"))
        both = ~np.isnan(a) & ~np.isnan(b)
        assert r["n"] == both.sum()
        assert r["corr"] == pytest.approx(np.corrcoef(a[both], b[both])[0, 1])


def test_classes(spark):
    rows = [("a", 0.2, 0.9, 0.0), ("b", 3.0, 0.1, 0.0), ("c", 0.2, 0.9, 0.5)]
    df = spark.createDataFrame(rows, "series_id string, cv double, seasonality_strength double, intermittency double")
    got = {r["series_id"]: (r["group"], r["variability"]) for r in profile.classify_series(df).collect()}
    assert got == {"a": ("A", "low"), "b": ("B", "high"), "c": ("C", "low")}


@pytest.fixture(scope="module")
def forecast(spark):
    t0 = datetime(2024, 1, 1)
    rows = []
    for sid, ys in {"a": [0, 5, 6, 0, 7, 7, 7, 0], "b": [1, 1, 1, 1, 9, 9, 1, 1]}.items():
        rows += [(sid, t0 + timedelta(hours=i), float(y), y - 1.0, y + 1.0, "m", t0 - timedelta(hours=1)) for i, y in enumerate(ys)]
    return spark.createDataFrame(
        rows, "asset_id string, timestamp timestamp_ntz, yhat double, lower double, upper double, model_version string, forecast_ts timestamp_ntz"
    )


def test_events(forecast):
    rows = decision.expected_events(forecast, HOUR, on=4.0, min_run=2).orderBy("asset_id", "start_ts").collect()
    assert [(r["asset_id"], r["n_steps"], r["start_ts"].hour, r["stop_ts"].hour, r["peak_ts"].hour) for r in rows] == [
        ("a", 2, 1, 3, 2),
        ("a", 3, 4, 7, 4),
        ("b", 2, 4, 6, 4),
    ]


def test_charge_is_clamped(forecast):
    net = forecast.where("asset_id = 'a'").withColumn("yhat", F.col("yhat") - 4)
    rows = decision.soc_envelope(net, capacity=5.0, soc0=3.0, target=4.5).orderBy("timestamp").collect()
    assert [r["soc"] for r in rows] == [0, 1, 3, 0, 3, 5, 5, 1]
    assert {r["first_reached_ts"].hour for r in rows} == {5}


def test_warping_of_unequal_lengths(spark):
    """Pairs are found whatever their lengths; the bound never exceeds the distance."""
    rng = np.random.default_rng(8)
    rows = [(f"s{i:02d}", (np.sin(np.arange(n) / n * 6) + rng.normal(size=n) * 0.05).round(4).tolist()) for i, n in enumerate([12, 12, 14, 17, 20, 20, 3])]
    df = spark.createDataFrame(rows, "series_id string, points array<double>")
    want = {}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1 :]:
            p, q = np.array([x]), np.array([y])
            d = similarity.warp_distance(p, q)[0]
            for band in (None, 3):
                assert similarity.warp_bound(p, q, band)[0] <= similarity.warp_distance(p, q, band)[0] + 1e-9
            if d <= 0.5:
                want[a, b] = pytest.approx(d)
    assert len(want) > 5
    assert {(r["id_a"], r["id_b"]): r["distance"] for r in similarity.dtw_within(df, 0.5).collect()} == want


def test_correlation_threshold_and_top(panel):
    rng = np.random.default_rng(2)
    base = rng.normal(size=80)
    df = panel({f"s{i}": (base * (i % 3) + rng.normal(size=80)).round(4).tolist() for i in range(7)})
    every = {(r["id_a"], r["id_b"]): r["corr"] for r in similarity.correlation_matrix(df, HOUR).collect()}
    assert len(every) == 21
    strong = {(r["id_a"], r["id_b"]) for r in similarity.correlation_matrix(df, HOUR, threshold=0.5).collect()}
    assert strong == {p for p, c in every.items() if abs(c) >= 0.5}
    first = {max((p for p in every if s in p), key=lambda p: abs(every[p])) for s in {x for p in every for x in p}}
    assert {(r["id_a"], r["id_b"]) for r in similarity.correlation_matrix(df, HOUR, top=1).collect()} == first


def test_alignments_together_are_those_alone():
    rng = np.random.default_rng(6)
    centre, members = rng.normal(size=9).round(1), rng.normal(size=(20, 12)).round(1)
    cost = similarity.warp_cost(np.tile(centre, (20, 1)), members)
    total, count = np.zeros(9), np.zeros(9)
    similarity.add_alignments(cost, members, total, count)
    want, n = np.zeros(9), np.zeros(9)
    for x in members:
        for i, j in similarity.warp_path(centre, x):
            want[i] += x[j]
            n[i] += 1
    assert total == pytest.approx(want) and count.tolist() == n.tolist()


def test_ranking_is_exact(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(f"a{i}", t0 + timedelta(hours=i % 3), float((i * 37) % 50)) for i in range(200)]
    df = spark.createDataFrame(rows, "asset_id string, timestamp timestamp_ntz, expected_value double")
    got = decision.rank_opportunities(df, 5).collect()
    for h in range(3):
        want = sorted(((-x, a) for a, t, x in rows if t.hour == h))[:5]
        have = sorted((r["rank"], -r["expected_value"], r["asset_id"]) for r in got if r["timestamp"].hour == h)
        assert [(x, a) for _, x, a in have] == want


def test_portfolio_sigma_holds_covariance(spark):
    t0 = datetime(2024, 1, 1)
    e = RNG.normal(size=(60, 3)).round(3)
    e[:, 1] = -e[:, 0]
    rows = [(f"s{j}", t0 + timedelta(hours=i), float(e[i, j])) for i in range(60) for j in range(3)]
    rows.pop()  # the last hour lacks an asset
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, resid double")
    r = decision.portfolio_uncertainty(df).collect()[0]
    total = [*e[:59].sum(axis=1), e[59, :2].sum()]
    assert (r["n_steps"], r["n_assets"]) == (60, 3)
    assert r["presence"] == pytest.approx(179 / 180)
    assert r["sigma_portfolio"] == pytest.approx(np.std(total, ddof=1))
    alone = [e[:, 0].var(ddof=1), e[:, 1].var(ddof=1), e[:59, 2].var(ddof=1)]
    assert r["sigma_independent"] == pytest.approx(np.sqrt(sum(alone)))


def test_portfolio_of_assets_that_never_meet(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(s, t0 + timedelta(hours=i + off), float(i % 5)) for s, off in (("a", 0), ("b", 30)) for i in range(30)]
    r = decision.portfolio_uncertainty(spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, resid double")).collect()[0]
    assert (r["n_steps"], r["n_assets"], r["presence"]) == (60, 2, 0.5) and r["sigma_portfolio"] > 0


def test_hierarchy_totals(forecast):
    placed = forecast.withColumn("region", F.lit("r")).withColumn("nation", F.col("asset_id"))
    rows = decision.portfolio_forecast(placed, ["region", "nation"]).collect()
    for depth, n in ((0, 8), (1, 8), (2, 16)):
        some = [r for r in rows if r["depth"] == depth]
        assert len(some) == n and sum(r["yhat"] for r in some) == 56


def test_scenarios_hold_every_asset(spark, forecast):
    """A missing residual leaves a NULL in the scenario, not a scenario without the asset."""
    t0 = datetime(2023, 12, 30)
    resid = [("a", t0 + timedelta(hours=i), float(i)) for i in range(24, 48)] + [("b", t0 + timedelta(hours=i), 1.0) for i in range(40)]
    df = spark.createDataFrame(resid, "series_id string, ts timestamp_ntz, resid double")
    rows = decision.scenarios(forecast, df, HOUR).collect()
    assert {(r["asset_id"], r["scenario_id"]) for r in rows} == {(a, d) for a in "ab" for d in (0, 1)}
    assert len(rows) == 2 * forecast.count()
    newest = sorted((r for r in rows if r["scenario_id"] == 0), key=lambda r: (r["asset_id"], r["timestamp"]))
    assert [r["value"] for r in newest if r["asset_id"] == "a"][:2] == [24.0, 30.0]
    assert all((r["value"] is None) == (r["timestamp"].hour >= 16) for r in newest if r["asset_id"] == "b")
    assert all(r["value"] is None for r in rows if r["asset_id"] == "a" and r["scenario_id"] == 1)
    assert len(decision.scenarios(forecast, df, HOUR, n=1).collect()) == forecast.count()


def test_flexibility_keeps_every_step(spark):
    """Steps without history at their hour and weekday take that of the hour, then of the series."""
    t0 = datetime(2024, 1, 1)
    history = [("a", t0 + timedelta(hours=i), float(i)) for i in range(30)]
    ahead = [(s, t0 + timedelta(days=2, hours=i), 10.0) for s in ("a", "new") for i in range(24)]
    made = spark.createDataFrame(ahead, "asset_id string, timestamp timestamp_ntz, yhat double")
    past = spark.createDataFrame(history, "series_id string, ts timestamp_ntz, value double")
    envelope = decision.flex_envelope(made, past, HOUR)
    rows = envelope.collect()
    assert len(rows) == 48
    assert all((r["reduction"] is None) == (r["asset_id"] == "new") for r in rows)
    at = {r["timestamp"].hour: r for r in rows if r["asset_id"] == "a"}
    assert at[12]["increase"] == 1.0 and at[12]["reduction"] == 0.0  # 12 at noon, and no ramp was larger than 1
    assert {r["n_assets"] for r in decision.portfolio_flexibility(envelope).collect()} == {1}


def test_ramps_stop_at_gaps(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0 + timedelta(hours=h), v, 0.0) for h, v in ((0, 0.0), (1, 1.0), (5, 400.0), (6, 700.0))]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double, yhat double")
    found = anomaly.unexpected_ramps(df, HOUR, k=100.0).collect()
    assert [(r["ts"].hour, r["actual_ramp"]) for r in found] == [(6, 300.0)]


def test_blocks_meet_without_pairs_of_arrays(spark, monkeypatch):
    """A crowded cell is cut into blocks, every pair of series meets once, and arrays don't travel with each pair."""
    monkeypatch.setattr(similarity, "PAIR_SERIES", 8, raising=False)
    rng = np.random.default_rng(3)
    rows = [(f"s{i:02d}", rng.normal(size=9 if i % 4 else 7).round(2).tolist(), "ab"[i % 2]) for i in range(70)]
    rows += [("s01", rows[1][1], "b"), (None, rows[1][1], "b"), ("z", [], "b"), ("y", rows[1][1], None), ("x", [0.0, None, 1.0], "a")]
    df = spark.createDataFrame(rows, "series_id string, points array<double>, category string")
    for radius in (1.0, 30.0):
        found = similarity.dtw_within(df, radius, within=["category"])
        plan = found._jdf.queryExecution().toString()
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
        want = {}
        for i, (a, p, c) in enumerate(rows):
            for b, q, d in rows[i + 1 :]:
                if a and b and a != b and p and q and c == d and c and None not in p and None not in q:
                    distance = warp_by_hand(p, q)
                    if distance <= radius:
                        want.setdefault((min(a, b), max(a, b)), []).append(pytest.approx(distance, abs=1e-9))
        got = {}
        for r in found.collect():
            got.setdefault((r["id_a"], r["id_b"]), []).append(r["distance"])
        assert got == want and len(want) >= (3 if radius == 1.0 else 1000)


def test_half_precision_loses_no_pair():
    rng = np.random.default_rng(4)
    for scale, offset in ((1.0, 0.0), (1e-3, 1e6), (1e-9, 0.0), (1.0, 1e17), (1e-20, 0.0)):
        x, y = rng.normal(size=(12, 400)) * scale + offset, rng.normal(size=(9, 400)) * scale + offset
        x[3, 5] = np.nan
        exact = similarity.warp_distance(x.T, y.T)
        for radius in (*np.quantile(exact[~np.isnan(exact)], [0.02, 0.5]), 1.0):
            if radius > 0:
                near, distance = similarity.close_pairs(x, y, float(radius))
                assert near.tolist() == np.flatnonzero(exact <= radius).tolist() and (distance == exact[near]).all()


@pytest.mark.parametrize("band", [None, 0, 2])
def test_alignment_sums_are_those_of_matrices(band):
    """The same sums as from cost matrices filled at scattered places."""
    rng = np.random.default_rng(6)
    for n, m in ((7, 7), (5, 9), (9, 5), (1, 4), (4, 1)):
        centre, members = rng.normal(size=n).round(1), rng.normal(size=(m, 30)).round(1)
        total, count = np.zeros(n), np.zeros(n)
        costs = similarity.warp_cost(np.tile(centre, (30, 1)), members.T, band)
        similarity.add_alignments(costs, members.T, total, count)
        s, c = similarity.alignment_sums(centre, members, band)
        assert s == pytest.approx(total) and c.tolist() == count.tolist()


def test_pairs_meet_in_the_jvm(spark, monkeypatch):
    """No Python worker aligns pairs without a band, and the distances are those of doubles whatever the lengths and sizes."""
    monkeypatch.setattr(similarity, "PAIR_SERIES", 25)
    rng = np.random.default_rng(11)
    kind = "series_id bigint, points array<double>, category string"
    for scale, offset, radius in ((1.0, 0.0, 2.5), (1.0, 0.0, 0.9), (1e-3, 1e6, 2e-3), (1e-20, 0.0, 2e-20), (1.0, 1e17, 20.0), (1e9, 0.0, 1e-9)):
        rows = [(i, (rng.normal(size=2 + int(rng.integers(8))) * scale + offset).tolist(), "ab"[i % 3 == 0]) for i in range(120)]
        rows += [(120 + i, p, c) for i, (_, p, c) in enumerate(rows[:3])]
        rows += [(130, [0.0, float("inf")], "a"), (131, [0.0, float("nan"), 0.0], "a"), (132, [0.0, None, 0.0], "a"), (133, [0.0, 0.0, float("-inf"), 0.0], "a")]
        found = similarity.dtw_within(spark.createDataFrame(rows, kind), radius, within=["category"])
        plan = found._jdf.queryExecution().toString()
        assert "MapPartitions" in plan and "FlatMapGroupsInArrow" not in plan
        want = {}
        for i, (a, p, c) in enumerate(rows[:-4]):
            for b, q, d in rows[i + 1 : -4]:
                if c == d:
                    distance = float(similarity.warp_distance(np.array([p]), np.array([q]))[0])
                    if distance <= radius:
                        want[a, b] = distance
        assert {(r["id_a"], r["id_b"]): r["distance"] for r in found.collect()} == want and len(want) >= 3


def test_lanes_fall_back_to_arrow(spark, monkeypatch):
    """Where the class can't be compiled, pairs are found all the same."""
    rng = np.random.default_rng(12)
    df = spark.createDataFrame([(f"s{i}", rng.normal(size=6).tolist()) for i in range(40)], "series_id string, points array<double>")
    want = {tuple(r) for r in similarity.dtw_within(df, 2.0).collect()}
    monkeypatch.setattr(similarity, "java_class", lambda *_: None)
    assert {tuple(r) for r in similarity.dtw_within(df, 2.0).collect()} == want and len(want) > 3
