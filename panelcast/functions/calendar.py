"""Calendar features of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def settlement_period(ts: Column) -> Column:
    """Half-hour of the day, 0 to 47."""
    return F.hour(ts) * 2 + F.floor(F.minute(ts) / 30).cast("int")


def time_features(ts: Column) -> dict[str, Column]:
    """Day of week counts from Monday = 0."""
    dow = F.weekday(ts)
    return {
        "date": F.to_date(ts),
        "month": F.month(ts).cast("bigint"),
        "dow": dow.cast("bigint"),
        "hour": F.hour(ts).cast("bigint"),
        "is_weekend": dow >= 5,
        "settlement_period": settlement_period(ts).cast("bigint"),
    }
