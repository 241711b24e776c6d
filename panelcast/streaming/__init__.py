"""The daily table and the residual check over a stream of metering rows."""

from panelcast.streaming.daily import stream_daily_energy, stream_residual_anomalies

__all__ = ["stream_daily_energy", "stream_residual_anomalies"]
