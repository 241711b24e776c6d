from __future__ import annotations

from datetime import datetime

import pytest

from panelcast.operators import clean, daily
from panelcast.plans.grid import DAY, HOUR, MONTH
from panelcast.schema import SERIES
from panelcast.sources import (
    load_model,
    csv_report,
    read_series_csv,
    read_series_parquet,
    save_model,
    to_long,
    to_wide,
    write_daily,
    write_series,
    write_series_csv,
)


def values(df, column="value"):
    return [r[column] for r in df.orderBy("series_id", "ts").collect()]


@pytest.mark.parametrize(
    "name,text,fmt,ts_col,value_col,first",
    [
        ("births.csv", "﻿Date,Births\n1/1/1959,35\n1/2/1959,32\n", "M/d/yyyy", "Date", "Births", datetime(1959, 1, 1)),
        ("air.csv", '"Month","Thousands"\n"1949-01",112\n"1949-02",118', "yyyy-MM", "Month", "Thousands", datetime(1949, 1, 1)),
        ("sales.csv", "DATE,S\n1992-01-01,3459\n1992-02-01,bad\n", "yyyy-MM-dd", "DATE", "S", datetime(1992, 1, 1)),
    ],
)
def test_csv_formats(spark, tmp_path, name, text, fmt, ts_col, value_col, first):
    (tmp_path / name).write_text(text, encoding="utf-8")
    df = read_series_csv(spark, str(tmp_path / name), ts_col=ts_col, value_col=value_col, ts_format=fmt)
    rows = df.orderBy("ts").collect()
    assert len(rows) == 2
    assert rows[0]["series_id"] == name.removesuffix(".csv")
    assert rows[0]["ts"] == first
    assert rows[1]["value"] is None if "bad" in text else rows[1]["value"] > 0


def test_write_and_read_back(spark, panel, tmp_path):
    df = panel({"a": [1, 2, None], "b": [4]})
    write_series(df, str(tmp_path / "s"))
    assert read_series_parquet(spark, str(tmp_path / "s")).count() == 4
    write_daily(daily.daily_metrics(df), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2
    write_series_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 4
    save_model(df, str(tmp_path / "m"))
    assert load_model(spark, str(tmp_path / "m")).count() == 4
    with pytest.raises(ValueError):
        read_series_parquet(spark, str(tmp_path / "d"))


def test_wide_and_long(spark, panel):
    wide = to_wide(panel({"a": [1, 2], "b": [3, 4]}), ["a", "b"])
    assert sorted((r["a"], r["b"]) for r in wide.collect()) == [(1, 3), (2, 4)]
    assert to_long(wide, ["a", "b"]).count() == 4


def test_regularize_fills_and_aggregates(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", t, 1.0), ("a", t.replace(minute=30), 2.0), ("a", t.replace(hour=3), 5.0), ("b", t.replace(hour=1), 7.0)]
    df = spark.createDataFrame(rows, SERIES)
    out = clean.regularize(df, HOUR)
    assert values(out) == [3.0, None, None, 5.0, 7.0]
    assert values(clean.regularize(df, HOUR, agg="last")) == [2.0, None, None, 5.0, 7.0]
    assert clean.regularize(df, HOUR, span="panel", fill=0.0).count() == 8
    assert clean.regularize(df, HOUR, start="2023-12-31 23:00:00", end="2024-01-01 01:00:00").count() == 6


def test_regularize_months(spark):
    rows = [("a", datetime(2023, 11, 5), 1.0), ("a", datetime(2024, 2, 29), 2.0)]
    out = clean.regularize(spark.createDataFrame(rows, SERIES), MONTH)
    assert [r["ts"].month for r in out.orderBy("ts").collect()] == [11, 12, 1, 2]


@pytest.mark.parametrize(("last", "kept"), [("2024-03-31", 3), ("2024-03-30", 2)])
def test_only_an_unfinished_cell_is_left_out(spark, last, kept):
    days = [datetime(2024, 1, 3), datetime(2024, 2, 9), datetime.fromisoformat(last)]
    df = spark.createDataFrame([("a", d, 1.0) for d in days], SERIES)
    assert clean.regularize(df, MONTH, span="panel", drop_partial=True, resolution=86400).count() == kept



@pytest.mark.parametrize("tile_rows", [2, 3, 1000])
def test_filling_does_not_depend_on_tiles(panel, tile_rows):
    df = panel({"a": [None, 2, None, None, None, 6, None, None], "b": [None, None], "c": [1]})
    out = clean.interpolate_time(df, HOUR, tile_rows=tile_rows)
    assert values(out) == [None, 2, 3, 4, 5, 6, 6, 6, None, None, 1]
    out = clean.ffill_bfill(df, HOUR, tile_rows=tile_rows)
    assert values(out) == [2, 2, 2, 2, 2, 6, 6, 6, None, None, 1]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",)], "value string")
    assert [r["value"] for r in clean.coerce_numeric(df).collect()] == [1.5]


def test_splits_agree_on_regular_panels(panel):
    df = panel({"a": list(range(30)), "b": [1, 2, 3]})
    for f in (lambda **k: clean.split_last(df, 2, **k), lambda **k: clean.split_fraction(df, 0.2, **k)):
        assert sorted(f().collect()) == sorted(f(step=HOUR).collect())
    assert clean.split_last(df, 2).where("part = 'test'").count() == 4


def test_gap_check(panel):
    df = panel({"a": [0, 1, 2, 3]}).union(panel({"a": [9]}, start=datetime(2024, 1, 2, 6)))
    row = clean.gap_check(df, HOUR).collect()[0]
    assert (row["n_gaps"], row["n_missing_steps"], row["longest_gap_seconds"]) == (1, 26, 27 * 3600.0)


def test_daily_metrics_by_hand(spark, panel):
    # Two days of 12-hour steps: the second day's first ramp crosses midnight.
    df = panel({"a": [1, 3, 0, -4], "b": [5]}, seconds=12 * 3600)
    rows = {(r["series_id"], r["date"].day): r for r in daily.daily_metrics(df).collect()}
    first, second, single = rows["a", 1], rows["a", 2], rows["b", 1]
    assert (first["mean_ramp_kw"], first["std_ramp_kw"], first["max_abs_ramp_kw"]) == (2, None, 2)
    assert second["mean_ramp_kw"] == pytest.approx(-3.5)
    assert second["std_ramp_kw"] == pytest.approx(0.5**0.5)
    assert second["mean_abs_ramp_kw"] == pytest.approx(3.5)
    assert second["coefficient_of_variation"] == 0  # negative mean
    assert second["intermittency_ratio"] == 0.5
    assert second["peak_to_avg_ratio"] == 0  # divided by 1
    assert (single["n_samples"], single["daily_std_kw"], single["mean_ramp_kw"]) == (1, None, None)
    assert single["coefficient_of_variation"] is None


@pytest.mark.parametrize("tile_seconds", [3600, 6 * 3600, DAY])
def test_daily_metrics_equal_plain_ramps(panel, tile_seconds):
    series = {"a": [((i * 7919) % 101) / 7 - 5 for i in range(200)], "b": [None, 1, None, 4, 4] * 20}
    df = panel(series)
    from pyspark.sql import functions as F

    plain = daily.ramp(df).groupBy("series_id", F.to_date("ts").alias("date")).agg(
        F.avg("ramp_kw").alias("m"), F.stddev_samp("ramp_kw").alias("s"), F.max("abs_ramp_kw").alias("x")
    )
    energy = daily.daily_energy_metrics(df).withColumnRenamed("daily_std_kw", "std")
    both = daily.daily_metrics(df, tile_seconds=tile_seconds).join(plain, ["series_id", "date"])
    both = both.join(energy.select("series_id", "date", "std"), ["series_id", "date"])
    assert both.count() == plain.count()
    for r in both.collect():
        assert r["daily_std_kw"] == (pytest.approx(r["std"]) if r["std"] is not None else None)
        assert r["mean_ramp_kw"] == pytest.approx(r["m"], abs=1e-9) if r["m"] is not None else r["mean_ramp_kw"] is None
        assert r["std_ramp_kw"] == pytest.approx(r["s"], abs=1e-9) if r["s"] is not None else r["std_ramp_kw"] is None
        assert r["max_abs_ramp_kw"] == (pytest.approx(r["x"]) if r["x"] is not None else None)


def test_quality_and_profile(panel):
    from pyspark.sql import functions as F

    df = panel({"a": [1, -2, None]}).withColumn("quality_flag", F.lit(1))
    assert clean.filter_quality(df, 0).count() == 0
    row = clean.profile(df).collect()[0]
    assert (row["n_rows"], row["n_missing"], row["n_negative"]) == (3, 1, 1)
    assert DAY == 24 * HOUR


def test_csv_report_accounts_for_every_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,v\n2024-01-01,1\n2024-01-02,\n,3\nnever,4\n2024-01-05,five\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("t,v\n2024-01-01,1\n", encoding="utf-8")
    options = {"ts_col": "t", "value_col": "v"}
    got = {(r["file"], r["outcome"]): r["n_lines"] for r in csv_report(spark, str(tmp_path), **options).collect()}
    outcomes = ("read", "no_value", "no_time", "bad_time", "bad_value")
    assert got == {("a.csv", o): 1 for o in outcomes} | {("b.csv", "read"): 1}
    assert read_series_csv(spark, str(tmp_path), **options).count() == 4
