"""What the plans must look like on a large cluster, checked on the small tables."""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.catalog import views
from panelcast.operators import anomaly, clean, daily, windows
from panelcast.plans.grid import HOUR
from panelcast.plans.quantiles import exact_quantiles, ranked_values, value_counts, value_place
from panelcast.plans.tiles import positions

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    """Keys of the shuffles, in the order of the plan text (last one first)."""
    found = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(df))
    return [re.sub(r"#\d+L?", "", keys) for keys in found]


def test_daily_metrics_reads_once_and_shuffles_rows_by_tile(spark):
    df = daily.daily_metrics(views.user_events(spark, SF_DIR))
    text = plan(df)
    assert text.count("FileScan") == 1
    assert exchanges(df) == ["series_id", "series_id, _tile"]
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["ts", "user_id", "value"]


def final_scans(df) -> int:
    """Scans of the adaptive plan that ran; a reused shuffle reads nothing again."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return final.count("FileScan")


def test_row_operators_read_once(spark):
    users = views.user_events(spark, SF_DIR, "event_type")
    assert final_scans(daily.ramp(users)) == 1
    assert final_scans(positions(users)) == 1
    assert final_scans(clean.gap_check(users, 86400)) == 1
    assert final_scans(clean.last_window(users, weeks=2)) == 2


def test_regularize_reads_once(spark):
    panel = views.type_events(spark, SF_DIR)
    assert final_scans(clean.regularize(panel, HOUR)) == 1
    assert final_scans(clean.regularize(panel, HOUR, span="panel", drop_partial=True)) == 1


@pytest.mark.parametrize("kind", ["outlier", "equal"])
def test_quantiles_have_no_hot_task(spark, kind):
    """One extreme outlier, or one value in nine of ten rows: no task sorts or sums a large share of the rows."""
    n = 20_000
    value = F.when(F.col("id") == 0, 1e12).otherwise(1 + F.col("id") / 1000.0) if kind == "outlier" else F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id") / 7.0)
    rows = spark.range(n).select(F.lit("a").alias("series_id"), value.alias("value"))
    freq = value_counts(rows, ["series_id"], "value")
    bins = freq.groupBy(F.floor(value_place(F.col("_v")) / (1 << 16))).agg(F.count("*").alias("k"))
    assert bins.agg(F.max("k")).first()[0] < n / 20
    got = exact_quantiles(rows, [0.0, 0.25, 0.5, 0.999, 1.0]).first()["q"]
    x = np.array([r["value"] for r in rows.collect()])
    assert got == pytest.approx(np.quantile(x, [0.0, 0.25, 0.5, 0.999, 1.0]))
    ranked = sorted((r["i"], r["value"]) for r in ranked_values(rows).collect())
    assert [i for i, _ in ranked] == list(range(1, n + 1)) and [v for _, v in ranked] == sorted(x.tolist())


def test_places_are_in_the_order_of_the_values(spark):
    rng = np.random.default_rng(3)
    x = np.unique(np.r_[rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300), 0.0, 5e-324, -5e-324, 1.7e308, np.inf, -np.inf, 2.0 ** np.arange(-60, 60), np.nextafter(2.0 ** np.arange(-60, 60), 0)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").select("v", value_place(F.col("v")).alias("p"))
    places = [r["p"] for r in df.orderBy("v").collect()]
    assert places == sorted(places)


def test_filters_reach_the_scan(spark):
    late = views.user_events(spark, SF_DIR).where(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    text = plan(daily.daily_energy_metrics(late))
    assert "GreaterThanOrEqual(ts" in re.search(r"PushedFilters: \[(.*?)\]", text).group(1)


def test_windows_share_one_shuffle(spark):
    panel = views.user_events(spark, SF_DIR)
    df = windows.feature_matrix(panel, HOUR, lags=[1, 2, 24], windows=[3, 24])
    assert exchanges(df) == ["series_id, _tile"]
    assert "BatchEvalPython" not in plan(df) and "ArrowEvalPython" not in plan(df)


@pytest.mark.parametrize(
    "build",
    [
        lambda p: daily.ramp(p),
        lambda p: windows.prefix_stats(p, HOUR),
        lambda p: anomaly.outliers_iqr(p),
        lambda p: anomaly.outliers_zscore(p),
    ],
)
def test_raw_rows_never_meet_per_series(spark, build):
    """No sort or window runs over the raw rows of one series in one task.

    With broadcasts off, the shuffles that carry raw rows (they hold ``value``
    unaggregated) must be keyed by tile or value, not by the series alone.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(build(views.user_events(spark, SF_DIR))).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for at, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(series_id#\d+, \d+\)", line):
            below = next(x for x in lines[at + 1 :] if not re.search(r"Project|Filter", x))
            assert "Aggregate" in below or "Generate" in below or "Join" in below, below


def test_carried_fits_read_once(spark):
    """Both passes over the rows read one shuffle; no history is copied per origin or fold."""
    from panelcast.operators import evaluate

    panel = views.type_events(spark, SF_DIR)
    rows = evaluate.rolling_origin(panel, "arima", HOUR, train_size=5, max_horizon=2)
    assert final_scans(rows) == 1
