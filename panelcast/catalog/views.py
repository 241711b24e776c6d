"""The test tables seen as series panels, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.operators.clean import regularize
from panelcast.plans.grid import DAY, HOUR, MONTH
from panelcast.sources.shapes import canonicalize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Irregular panel: one series per user."""
    mapping = {"series_id": "user_id", "ts": "ts", "value": "value"}
    return canonicalize(table(spark, sf_dir, "events"), mapping, extra)


def type_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular panel: one series per event type."""
    mapping = {"series_id": "event_type", "ts": "ts", "value": "value"}
    return canonicalize(table(spark, sf_dir, "events"), mapping)


def _tidy(df: DataFrame, digits: int) -> DataFrame:
    return df.withColumn("value", F.round("value", digits))


def hourly(spark: SparkSession, sf_dir: str, fill: float | None = 0.0) -> DataFrame:
    """Hourly totals per event type, complete over the panel's span."""
    return _tidy(regularize(type_events(spark, sf_dir), HOUR, span="panel", fill=fill), 6)


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"series_id": "o_orderpriority", "ts": "o_orderdate", "value": "o_totalprice"}
    return canonicalize(table(spark, sf_dir, "orders"), mapping)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order value per priority; the month of the last order is left out unless that is its last day."""
    orders = order_series(spark, sf_dir)
    return _tidy(regularize(orders, MONTH, span="panel", fill=0.0, drop_partial=True, resolution=DAY), 4)


def daily_orders(spark: SparkSession, sf_dir: str, fill: float | None = 0.0) -> DataFrame:
    """Daily order value per market segment of the customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    mapping = {"series_id": "c_mktsegment", "ts": "o_orderdate", "value": "o_totalprice"}
    return _tidy(regularize(canonicalize(joined, mapping), DAY, span="panel", fill=fill), 4)


def supplier_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per supplier on the days it shipped."""
    lines = table(spark, sf_dir, "lineitem")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return canonicalize(
        lines.select("l_suppkey", "l_shipdate", revenue.alias("revenue")),
        {"series_id": "l_suppkey", "ts": "l_shipdate", "value": "revenue"},
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows as short series held in one array."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("series_id"),
        F.col("embedding").cast("array<double>").alias("points"),
        F.col("label").cast("string").alias("category"),
    )


U = "u AS (SELECT CAST(user_id AS VARCHAR) AS series_id, ts, value, event_type FROM events)"

_TH = """th AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, round(sum(value), 6) AS value
  FROM events GROUP BY 1, 2),
tg AS (SELECT s.series_id, g.ts FROM (SELECT DISTINCT series_id FROM th) s CROSS JOIN
  (SELECT unnest(generate_series((SELECT min(ts) FROM th), (SELECT max(ts) FROM th), INTERVAL 1 HOUR)) AS ts) g)"""

T = f"""{_TH},
t AS (SELECT tg.series_id, tg.ts, coalesce(th.value, 0.0) AS value,
  row_number() OVER (PARTITION BY tg.series_id ORDER BY tg.ts) AS rn
  FROM tg LEFT JOIN th USING (series_id, ts))"""

T_GAPS = f"""{_TH},
tn AS (SELECT tg.series_id, tg.ts, th.value FROM tg LEFT JOIN th USING (series_id, ts))"""

M = """mo AS (SELECT o_orderpriority AS series_id, date_trunc('month', o_orderdate)::TIMESTAMP AS ts,
  round(sum(o_totalprice), 4) AS value FROM orders GROUP BY 1, 2),
ml AS (SELECT * FROM mo WHERE ts + INTERVAL 1 MONTH <= (SELECT max(o_orderdate)::TIMESTAMP + INTERVAL 1 DAY FROM orders)),
mg AS (SELECT s.series_id, g.ts FROM (SELECT DISTINCT series_id FROM ml) s CROSS JOIN
  (SELECT unnest(generate_series((SELECT min(ts) FROM ml), (SELECT max(ts) FROM ml), INTERVAL 1 MONTH)) AS ts) g),
m AS (SELECT mg.series_id, mg.ts, coalesce(ml.value, 0.0) AS value,
  row_number() OVER (PARTITION BY mg.series_id ORDER BY mg.ts) AS rn
  FROM mg LEFT JOIN ml USING (series_id, ts))"""

D = """dy AS (SELECT c_mktsegment AS series_id, date_trunc('day', o_orderdate)::TIMESTAMP AS ts,
  round(sum(o_totalprice), 4) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
dg AS (SELECT s.series_id, g.ts FROM (SELECT DISTINCT series_id FROM dy) s CROSS JOIN
  (SELECT unnest(generate_series((SELECT min(ts) FROM dy), (SELECT max(ts) FROM dy), INTERVAL 1 DAY)) AS ts) g),
d AS (SELECT dg.series_id, dg.ts, coalesce(dy.value, 0.0) AS value,
  row_number() OVER (PARTITION BY dg.series_id ORDER BY dg.ts) AS rn
  FROM dg LEFT JOIN dy USING (series_id, ts))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def with_recursive(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"
