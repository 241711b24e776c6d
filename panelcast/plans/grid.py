"""Time grid arithmetic: a step is a number of seconds or a calendar month."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONTH = "month"
HOUR = 3600
DAY = 86400

Step = int | str


def grid_index(ts: Column, step: Step) -> Column:
    """Number of the grid cell that holds ``ts``, counted from a fixed origin."""
    if step == MONTH:
        return (F.year(ts) * 12 + F.month(ts) - 1).cast("bigint")
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(float(step) * 1e6))


def grid_time(index: Column, step: Step) -> Column:
    """Start of a grid cell; the inverse of :func:`grid_index`."""
    if step == MONTH:
        year = F.floor(index / 12)
        month = index - year * 12 + 1
        return F.make_date(year.cast("int"), month.cast("int"), F.lit(1)).cast("timestamp_ntz")
    return F.timestamp_seconds(index * F.lit(int(step))).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds as a double."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1e6)
