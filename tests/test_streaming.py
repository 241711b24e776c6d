from __future__ import annotations

from datetime import datetime, timedelta

from panelcast.operators.daily import daily_energy_metrics
from panelcast.operators.forecast.baseline import forecast_mean
from panelcast.operators.forecast.contract import to_contract
from panelcast.plans.grid import HOUR
from panelcast.schema import SERIES
from panelcast.streaming import stream_daily_energy, stream_residual_anomalies


def drain(df, name, tmp_path):
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / name))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    return df.sparkSession.table(name)


def test_stream_equals_batch(spark, panel, tmp_path):
    df = panel({"a": [float(i % 9) for i in range(96)], "b": [2.0] * 48})
    df.write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(SERIES).parquet(str(tmp_path / "rows"))
    got = drain(stream_daily_energy(stream), "days", tmp_path)
    # The last day stays open: the watermark has not passed its end.
    want = daily_energy_metrics(df).where("date < DATE'2024-01-04'")
    columns = ["series_id", "date", "daily_energy_kwh", "daily_peak_kw", "n_samples"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())


def test_residuals_against_a_stored_forecast(spark, panel, tmp_path):
    history = panel({"a": [1.0, 2.0, 3.0, 2.0]})
    forecast = to_contract(forecast_mean(history, 4, HOUR), "mean")
    later = panel({"a": [2.0, 90.0]}, start=datetime(2024, 1, 1) + timedelta(hours=4))
    later.write.parquet(str(tmp_path / "later"))
    stream = spark.readStream.schema(SERIES).parquet(str(tmp_path / "later"))
    rows = drain(stream_residual_anomalies(stream, forecast), "odd", tmp_path).collect()
    assert [r["resid"] for r in rows] == [88.0]
