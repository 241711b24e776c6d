"""Fingerprint, clustering and warping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import views as v
from panelcast.catalog.anomalies import decompose_sql
from panelcast.catalog.registry import query
from panelcast.operators import profile, similarity
from panelcast.operators.clean import regularize
from panelcast.plans.grid import DAY, HOUR

PRINT = decompose_sql(24) + """,
x AS (SELECT *, abs(value - lag(value) OVER w) AS ramp, value - lag(value, 24) OVER w AS e, value - avg(value) OVER (PARTITION BY series_id) AS c
  FROM t WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
y AS (SELECT *, lag(c) OVER (PARTITION BY series_id ORDER BY ts) AS c1 FROM x),
ss AS (SELECT series_id, greatest(0, 1 - var_samp(resid) / var_samp(CASE WHEN resid IS NOT NULL THEN seasonal + resid END)) AS strength FROM dc GROUP BY 1),
fp AS (SELECT y.series_id, avg(value) AS mean_load, var_samp(value) AS variance, CASE WHEN avg(value) > 0 THEN stddev_samp(value) / avg(value) ELSE 0 END AS cv,
  sum(c * c1) / nullif(sum(c * c), 0) AS acf_1, max(strength) AS seasonality_strength, count(*) FILTER (abs(value) < 1) / count(*) AS intermittency,
  max(value) / CASE WHEN avg(value) > 0 THEN avg(value) ELSE 1 END AS peak_to_avg, avg((ramp > 100)::INT) AS ramp_frequency, avg(ramp) AS ramp_size,
  sqrt(avg(e * e)) AS forecast_rmse, quantile_cont(e, 0.9) - quantile_cont(e, 0.1) AS interval_width FROM y JOIN ss USING (series_id) GROUP BY 1)"""


def prints(spark, sf):
    return profile.fingerprint(v.hourly(spark, sf), HOUR, period=24, ramp_threshold=100.0, eps=1.0)


@query("fingerprint", v.with_(v.T, PRINT) + "SELECT series_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in profile.FEATURES) + " FROM fp")
def _(spark, sf):
    return prints(spark, sf)


@query("classify_series", v.with_(v.T, PRINT) + """
SELECT series_id, g AS "group", CASE g WHEN 'A' THEN 'sarima' WHEN 'B' THEN 'gbdt' ELSE 'quantile' END AS model,
  CASE WHEN cv < 0.5 THEN 'low' WHEN cv < 2 THEN 'medium' ELSE 'high' END AS variability FROM (
  SELECT *, CASE WHEN intermittency >= 0.05 THEN 'C' WHEN seasonality_strength >= 0.1 AND cv < 0.5 THEN 'A' ELSE 'B' END AS g FROM fp)""")
def _(spark, sf):
    return profile.classify_series(prints(spark, sf), seasonality=0.1, zeros=0.05)


def user_days(spark, sf):
    """Daily totals per user, a regular panel with many series."""
    return regularize(v.user_events(spark, sf), DAY, span="panel", fill=0.0)


def user_prints(panel):
    return profile.fingerprint(panel, DAY, period=7, ramp_threshold=50.0, eps=1e-6).fillna(0.0)


FEATURES = ["mean_load", "cv", "acf_1", "seasonality_strength", "intermittency", "ramp_frequency"]


@query("cluster_series")
def _(spark, sf):
    return similarity.cluster_series(user_prints(user_days(spark, sf)), FEATURES, k=3)


@query("cluster_choose_k")
def _(spark, sf):
    return similarity.choose_k(user_prints(user_days(spark, sf)), FEATURES, ks=(3, 4))


BANDS = """b AS (SELECT series_id, ts < TIMESTAMP '2024-01-16' AS early, avg(value) AS m FROM u GROUP BY 1, 2),
c AS (SELECT *, CASE WHEN m < 40 THEN 0 WHEN m < 60 THEN 1 ELSE 2 END AS cluster FROM b),
j AS (SELECT a.cluster AS from_cluster, z.cluster AS to_cluster FROM c a JOIN c z USING (series_id) WHERE a.early AND NOT z.early)"""


@query("cluster_stability", v.with_(v.U, BANDS) + """
SELECT CAST(from_cluster AS BIGINT) AS from_cluster, CAST(to_cluster AS BIGINT) AS to_cluster, count(*) AS n_series,
  round((SELECT avg((from_cluster <> to_cluster)::INT) FROM j), 6) AS share_changed FROM j GROUP BY 1, 2""")
def _(spark, sf):
    users = v.user_events(spark, sf)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")

    def bands(rows):
        m = F.avg("value")
        return rows.groupBy("series_id").agg(F.when(m < 40, 0).when(m < 60, 1).otherwise(2).alias("cluster"))

    return profile.cluster_stability(bands(users.where(early)), bands(users.where(~early)))


def typed_points(spark, sf):
    panel = v.hourly(spark, sf)
    day = regularize(panel, DAY, span="panel", fill=0.0)
    return similarity.as_points(day)


# Warping cost by anti-diagonals; position i + 1 of a list is row i of the cost matrix.
WARP = """dd AS (SELECT series_id, CAST(ts AS DATE) AS day, round(sum(value), 9) AS value FROM t GROUP BY 1, 2),
pt AS (SELECT series_id, list(value ORDER BY day) AS p, count(*)::BIGINT AS n FROM dd GROUP BY 1),
wp AS (SELECT x.series_id AS id_a, y.series_id AS id_b, x.p AS a, y.p AS b, x.n, y.n AS m, 0::BIGINT AS d,
  list_transform(range(0, x.n + 1), lambda i: CASE WHEN i = 0 THEN 0.0 ELSE 'inf'::DOUBLE END) AS before,
  list_transform(range(0, x.n + 1), lambda i: 'inf'::DOUBLE) AS last FROM pt x JOIN pt y ON x.series_id < y.series_id
  UNION ALL SELECT id_a, id_b, a, b, n, m, d + 1, last, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 OR i - 1 < d - m + 1 OR i - 1 > d
    THEN 'inf'::DOUBLE ELSE pow(a[i] - b[d - i + 2], 2) + least(last[i], last[i + 1], before[i]) END) FROM wp WHERE d < n + m - 1)"""


@query("dtw_matrix", v.with_recursive(v.T, WARP) + "SELECT id_a, id_b, round(sqrt(last[n + 1]), 6) AS distance FROM wp WHERE d = n + m - 1")
def _(spark, sf):
    return similarity.dtw_matrix(typed_points(spark, sf))


@query("dtw_path")
def _(spark, sf):
    points = typed_points(spark, sf)
    total = points.agg(F.max_by("points", "series_id").alias("points_b"), F.max("series_id").alias("id_b"))
    pairs = points.select(F.col("series_id").alias("id_a"), F.col("points").alias("points_a")).crossJoin(F.broadcast(total))
    paths = similarity.dtw_path(pairs)
    return paths.select("id_a", "id_b", F.posexplode("path").alias("step", "_p")).select("id_a", "id_b", "step", "_p.i", "_p.j")


# Each pair's path adds up to its distance: the squared cost along the path against the matrix of SQL.
@query("dtw_path_cost", v.with_recursive(v.T, WARP.replace("ON x.series_id < y.series_id", "ON y.series_id = (SELECT max(series_id) FROM pt)")) + """
SELECT id_a, id_b, round(sqrt(last[n + 1]), 6) AS distance FROM wp WHERE d = n + m - 1""")
def _(spark, sf):
    points = typed_points(spark, sf)
    last = points.agg(F.max_by("points", "series_id").alias("points_b"), F.max("series_id").alias("id_b"))
    pairs = points.select(F.col("series_id").alias("id_a"), F.col("points").alias("points_a")).crossJoin(F.broadcast(last))
    cost = F.aggregate("path", F.lit(0.0), lambda s, p: s + F.pow(F.col("points_a")[p["i"]] - F.col("points_b")[p["j"]], 2))
    return similarity.dtw_path(pairs).select("id_a", "id_b", F.sqrt(cost).alias("distance"))


RADIUS = 0.65
NEAR = WARP[WARP.index("wp AS") :].replace(
    "ON x.series_id < y.series_id",
    f"ON x.series_id < y.series_id AND x.label = y.label AND pow(x.p[1] - y.p[1], 2) + pow(x.p[x.n] - y.p[y.n], 2) <= {RADIUS * RADIUS}",
)
VECTORS = "pt AS (SELECT CAST(vec_id AS VARCHAR) AS series_id, CAST(embedding AS DOUBLE[]) AS p, len(embedding)::BIGINT AS n, label FROM embeddings)"


@query("dtw_pairs", v.with_recursive(VECTORS, NEAR) + f"""
SELECT id_a, id_b, round(sqrt(last[n + 1]), 6) AS distance FROM wp WHERE d = n + m - 1 AND sqrt(last[n + 1]) <= {RADIUS}""")
def _(spark, sf):
    return similarity.dtw_within(v.vectors(spark, sf), radius=RADIUS, within=["category"])


@query("dtw_cluster")
def _(spark, sf):
    return similarity.dtw_cluster(v.vectors(spark, sf), k=3)
