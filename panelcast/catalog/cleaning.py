"""Cleaning and shaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.registry import query
from panelcast.operators import clean, windows
from panelcast.plans.grid import HOUR
from panelcast.session import shared_dir
from panelcast.sources import csv_report, read_series_csv, read_series_parquet, write_series, write_series_csv
from panelcast.sources.shapes import to_long, to_wide

TYPES = ["click", "error", "purchase", "signup", "view"]


@query("regularize", v.with_(v.T_GAPS) + "SELECT series_id, ts, round(value, 6) AS value FROM tn")
def _(spark, sf):
    return v.hourly(spark, sf, fill=None)


@query("missing_pct", v.with_(v.T_GAPS) + """
SELECT c AS "column", n_missing, round(missing_pct, 6) AS missing_pct FROM (
  SELECT 'series_id' AS c, count(*) FILTER (series_id IS NULL) AS n_missing, 100.0 * avg((series_id IS NULL)::INT) AS missing_pct FROM tn
  UNION ALL SELECT 'ts', count(*) FILTER (ts IS NULL), 100.0 * avg((ts IS NULL)::INT) FROM tn
  UNION ALL SELECT 'value', count(*) FILTER (value IS NULL), 100.0 * avg((value IS NULL)::INT) FROM tn)""")
def _(spark, sf):
    return clean.missing_pct(v.hourly(spark, sf, fill=None))


CENTRED = "c AS (SELECT series_id, ts, round(value - avg(value) OVER (PARTITION BY series_id), 6) AS value FROM t)"


def centred_hourly(spark, sf):
    t = v.hourly(spark, sf)
    means = t.groupBy("series_id").agg(F.avg("value").alias("_m"))
    return t.join(means, "series_id").select(
        "series_id", "ts", F.round(F.col("value") - F.col("_m"), 6).alias("value")
    )


@query("negative_count", v.with_(v.T, CENTRED) + "SELECT count(*) FILTER (value < 0) AS n_negative FROM c")
def _(spark, sf):
    return clean.negative_count(centred_hourly(spark, sf))


FILL = """
n AS (SELECT series_id, ts, value,
  last_value(value IGNORE NULLS) OVER a AS pv, last_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER a AS pt,
  first_value(value IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS nt
  FROM tn WINDOW a AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("interpolate_time", v.with_(v.T_GAPS, FILL) + """
SELECT series_id, ts, round(coalesce(value, pv + (nv - pv) * (epoch(ts) - epoch(pt)) / nullif(epoch(nt) - epoch(pt), 0), pv), 6) AS value
FROM n""")
def _(spark, sf):
    return clean.interpolate_time(v.hourly(spark, sf, fill=None), HOUR)


@query("ffill_bfill", v.with_(v.T_GAPS, FILL) + "SELECT series_id, ts, round(coalesce(value, pv, nv), 6) AS value FROM n")
def _(spark, sf):
    return clean.ffill_bfill(v.hourly(spark, sf, fill=None), HOUR)


@query("coerce_numeric", """
SELECT CAST(user_id AS VARCHAR) AS series_id, ts, round(TRY_CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE), 6) AS value
FROM events WHERE TRY_CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE) IS NOT NULL""")
def _(spark, sf):
    text = F.regexp_replace(F.regexp_replace("props", r'^\{"k": ', ""), r"\}$", "")
    events = v.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("series_id"), "ts", text.alias("value"))
    return clean.coerce_numeric(events)


@query("last_window", v.with_(v.U) + """
SELECT series_id, ts, round(value, 6) AS value FROM (
  SELECT *, max(ts) OVER (PARTITION BY series_id) AS mx FROM u) WHERE ts >= mx - INTERVAL 14 DAY""")
def _(spark, sf):
    return clean.last_window(v.user_events(spark, sf), weeks=2)


@query("split_fraction", v.with_(v.U) + """
SELECT series_id, ts, round(value, 6) AS value, CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'validation' END AS part FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM u)""")
def _(spark, sf):
    return clean.split_fraction(v.user_events(spark, sf), 0.2)


@query("split_last", v.with_(v.U) + """
SELECT series_id, ts, round(value, 6) AS value, CASE WHEN r <= 12 THEN 'test' ELSE 'train' END AS part FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS r FROM u)""")
def _(spark, sf):
    return clean.split_last(v.user_events(spark, sf), 12)


@query("data_profile", v.with_(v.U) + """
SELECT count(*) AS n_rows, count(DISTINCT series_id) AS n_series, min(ts) AS first_ts, max(ts) AS last_ts,
  count(*) FILTER (value IS NULL) AS n_missing, count(*) FILTER (value < 0) AS n_negative, count(DISTINCT event_type) AS n_categories FROM u""")
def _(spark, sf):
    return clean.profile(v.user_events(spark, sf, "event_type"), category="event_type")


@query("gap_check", v.with_(v.U) + """,
w AS (SELECT series_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY series_id ORDER BY ts))) / 1e6 AS width FROM u)
SELECT series_id, count(*) AS n_rows, count(*) FILTER (width > 86400) AS n_gaps,
  round(max(CASE WHEN width > 86400 THEN width END), 6) AS longest_gap_seconds,
  CAST(coalesce(sum(CASE WHEN width > 86400 THEN ceil(width / 86400) - 1 END), 0) AS BIGINT) AS n_missing_steps
FROM w GROUP BY series_id""".replace("\n,", ",", 1))
def _(spark, sf):
    return clean.gap_check(v.user_events(spark, sf), 86400)


@query("quality_filter", v.with_(v.T_GAPS) + """
SELECT series_id, ts, round(value, 6) AS value, CAST(0 AS BIGINT) AS quality_flag FROM tn WHERE value IS NOT NULL""")
def _(spark, sf):
    t = v.hourly(spark, sf, fill=None)
    flag = F.when(F.col("value").isNull(), 2).otherwise(0)
    return clean.filter_quality(t.withColumn("quality_flag", flag), max_flag=1)


@query("time_features", v.with_(v.U) + """
SELECT series_id, ts, round(value, 6) AS value, CAST(ts AS DATE) AS date, month(ts) AS month, isodow(ts) - 1 AS dow, hour(ts) AS hour,
  isodow(ts) >= 6 AS is_weekend, CAST(hour(ts) * 2 + floor(minute(ts) / 30) AS BIGINT) AS settlement_period FROM u""")
def _(spark, sf):
    return clean.time_features(v.user_events(spark, sf))


@query("value_flags", v.with_(v.T, CENTRED) + """
SELECT series_id, ts, value, value > 0 AS is_positive, value = 0 AS is_zero, value < -100 OR value > 100 AS is_outside,
  hour(ts) BETWEEN 7 AND 19 AS in_hours FROM c""")
def _(spark, sf):
    return clean.flag_values(centred_hourly(spark, sf), lo=-100.0, hi=100.0, hours=(7, 19))


@query("future_frame", v.with_(v.M) + """
SELECT series_id, h, CAST(last + to_months(CAST(h AS INTEGER)) AS TIMESTAMP) AS ts FROM (SELECT series_id, max(ts) AS last FROM m GROUP BY 1)
CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS h)""")
def _(spark, sf):
    return windows.future_frame(v.monthly(spark, sf), 12, "month")


@query("to_wide", v.with_(v.T) + "SELECT ts, " + ", ".join(
    f"max(CASE WHEN series_id = '{t}' THEN round(value, 6) END) AS \"{t}\"" for t in TYPES) + " FROM t GROUP BY ts")
def _(spark, sf):
    return to_wide(v.hourly(spark, sf), TYPES)


@query("to_long", """SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, series_id, round(sum(value), 2) AS value FROM (
  UNPIVOT (SELECT l_shipdate, l_quantity, l_extendedprice, l_tax FROM lineitem)
  ON l_quantity, l_extendedprice, l_tax INTO NAME series_id VALUE value) GROUP BY 1, 2""", digits=2)
def _(spark, sf):
    long = to_long(v.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], ts="l_shipdate")
    return long.groupBy(F.col("l_shipdate").alias("ts"), "series_id").agg(F.sum("value").alias("value"))


@query("parquet_round_trip", v.with_(v.T_GAPS) + "SELECT series_id, ts, round(value, 6) AS value FROM tn")
def _(spark, sf):
    path = shared_dir(spark, "series")
    write_series(v.hourly(spark, sf, fill=None), path)
    return read_series_parquet(spark, path).select("series_id", "ts", "value")


CSV = {"ts_col": "ts", "value_col": "value", "ts_format": "yyyy-MM-dd'T'HH:mm:ss.SSS", "series_col": "series_id"}


@query("csv_round_trip", v.with_(v.T_GAPS) + "SELECT series_id, ts, round(value, 6) AS value FROM tn")
def _(spark, sf):
    path = shared_dir(spark, "csv")
    write_series_csv(v.hourly(spark, sf, fill=None).select("series_id", "ts", "value"), path)
    return read_series_csv(spark, path, **CSV)


@query("csv_report", v.with_(v.T_GAPS) + "SELECT CASE WHEN value IS NULL THEN 'no_value' ELSE 'read' END AS outcome, count(*) AS n_lines FROM tn GROUP BY 1")
def _(spark, sf):
    path = shared_dir(spark, "csv")
    write_series_csv(v.hourly(spark, sf, fill=None).select("series_id", "ts", "value"), path)
    return csv_report(spark, path, **CSV).groupBy("outcome").agg(F.sum("n_lines").alias("n_lines"))


@query("canonicalize", """SELECT CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS TIMESTAMP) AS ts,
  round(l_extendedprice, 6) AS value, l_returnflag AS category FROM lineitem""")
def _(spark, sf):
    from panelcast.sources.shapes import canonicalize

    lines = v.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "category")
    mapping = {"series_id": "l_suppkey", "ts": "l_shipdate", "value": "l_extendedprice"}
    return canonicalize(lines, mapping, ["category"])
