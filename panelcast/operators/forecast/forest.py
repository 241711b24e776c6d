"""Tree forecasters: one MLlib model over all series, applied step by step.

Fitting runs jobs (MLlib).  The recursion needs only the newest rows of a
series, so a group handed to Python is as long as the longest lag.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.operators.clean import split_fraction
from panelcast.operators.forecast.baseline import level_probs, shape_forecast
from panelcast.plans.grid import Step, grid_index, grid_time
from panelcast.plans.tiles import over_tiles
from panelcast.session import shared_dir

SEED = 42
NOT_FEATURES = ("series_id", "ts", "y", "part")


def feature_names(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in NOT_FEATURES]


def _fit(features: DataFrame, learner) -> PipelineModel:
    rows = features.dropna()
    assemble = VectorAssembler(inputCols=feature_names(features), outputCol="features")
    return Pipeline(stages=[assemble, learner.setFeaturesCol("features").setLabelCol("y")]).fit(rows)


def fit_random_forest(
    features: DataFrame, *, n_trees: int = 100, max_depth: int = 8, max_bins: int = 64, seed: int = SEED
) -> PipelineModel:
    """A forest over the rows of all series, every feature tried at every split."""
    learner = RandomForestRegressor(
        numTrees=n_trees, maxDepth=max_depth, maxBins=max_bins, featureSubsetStrategy="all", cacheNodeIds=True, seed=seed
    )
    return _fit(features, learner)


def fit_gbt(features: DataFrame, *, n_trees: int = 20, max_depth: int = 5, seed: int = SEED) -> PipelineModel:
    return _fit(features, GBTRegressor(maxIter=n_trees, maxDepth=max_depth, seed=seed))


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """One-step predictions for rows whose features are known."""
    return model.transform(features).select("series_id", "ts", "y", F.col("prediction").alias("yhat"))


def grid_search_forest(
    features: DataFrame, grid: Sequence[dict], *, val_fraction: float = 0.2, seed: int = SEED
) -> tuple[dict, DataFrame]:
    """Best parameters by RMSE on the last part of each series, and the score table.

    The loop is over parameter sets; each fit is a distributed job.
    """
    parts = split_fraction(features, val_fraction).persist()
    train, check = (parts.where(F.col("part") == p).drop("part") for p in ("train", "validation"))
    score = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName="rmse")
    results = []
    for i, params in enumerate(grid):
        model = fit_random_forest(train, seed=seed, **params)
        results.append((i, str(params), float(score.evaluate(model.transform(check)))))
    parts.unpersist()
    best = min(results, key=lambda r: r[2])[0]
    table = features.sparkSession.createDataFrame(results, "trial int, params string, rmse double")
    return dict(grid[best]), table


@dataclass(frozen=True)
class FlatTrees:
    """All trees as arrays [tree, node]; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    #: Boosted trees add up by weights; a forest's trees (None) count alike.
    weights: np.ndarray | None = None

    def combined(self, votes: np.ndarray) -> np.ndarray:
        return votes.mean(axis=1) if self.weights is None else votes @ self.weights

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Every tree's prediction for each row of features: [row, tree]."""
        trees, rows = np.arange(len(self.value)), np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(trees)), dtype=int)
        for _ in range(self.depth):
            go_left = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(go_left, self.left[trees, node], self.right[trees, node])
        return self.value[trees, node]


def flatten_trees(spark: SparkSession, model: PipelineModel) -> FlatTrees:
    """Read a fitted forest's (or boosted trees') nodes; their number is bounded by trees * 2^(depth + 1)."""
    forest = model.stages[-1]
    weights = np.array(forest.treeWeights) if isinstance(forest, GBTRegressionModel) else None
    path = shared_dir(spark, "forest")
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        "nodeData.id",
        "nodeData.prediction",
        "nodeData.leftChild",
        "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )
    table = nodes.toPandas()
    trees, width = int(table["treeID"].max()) + 1, int(table["id"].max()) + 1
    shape = (trees, width)
    own = np.tile(np.arange(width), (trees, 1))
    feature, threshold = np.zeros(shape, dtype=int), np.full(shape, np.inf)
    left, right, value = own.copy(), own.copy(), np.zeros(shape)
    at = (table["treeID"].to_numpy(), table["id"].to_numpy())
    value[at] = table["prediction"].to_numpy()
    inner = table[table["leftChild"] >= 0]
    at = (inner["treeID"].to_numpy(), inner["id"].to_numpy())
    feature[at] = inner["feature"].to_numpy()
    threshold[at] = inner["threshold"].to_numpy(dtype=float)
    left[at], right[at] = inner["leftChild"].to_numpy(), inner["rightChild"].to_numpy()
    return FlatTrees(feature, threshold, left, right, value, forest.getOrDefault("maxDepth"), weights)


def forecast_recursive(
    df: DataFrame,
    model: PipelineModel,
    horizon: int,
    step: Step,
    *,
    lags: Sequence[int],
    windows: Sequence[int],
    level: float = 0.95,
) -> DataFrame:
    """Predict a step, append it, rebuild the features, and go on, for every series of a batch at once.

    The interval is the spread of the single trees' predictions; boosted trees, which correct each other, have none
    (NULL).  A series with fewer rows than the longest lag or window, or a gap among them, has no rows.
    """
    if step == "month":
        raise ValueError("hour and weekday features need a step of fixed length")
    spark = df.sparkSession
    trees = spark.sparkContext.broadcast(flatten_trees(spark, model))
    reach = max(*lags, *windows)
    tail = over_tiles(
        df.select("series_id", "ts", "value"),
        lambda w: {"_after": F.lead(F.lit(1), reach).over(w)},
        step=step,
        ahead=reach,
    ).where(F.col("_after").isNull())
    # One row per series, with its newest values: as long as the longest lag.
    newest = tail.groupBy("series_id").agg(
        F.max("ts").alias("origin_ts"), F.array_sort(F.collect_list(F.struct("ts", "value"))).alias("_t")
    )
    known = F.forall("_t", lambda r: r["value"].isNotNull())
    newest = newest.where((F.size("_t") >= reach) & known).select(
        "series_id", "origin_ts", F.transform(F.slice("_t", -reach, reach), lambda r: r["value"]).alias("_y")
    )
    lo, hi = (100 * p for p in level_probs(level))
    lag_at, windows, seconds = np.array(list(lags)), list(windows), int(step)

    def extend(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            y = np.stack(pdf["_y"].to_numpy()).astype(float)
            path = np.concatenate([y, np.zeros((len(y), horizon))], axis=1)
            out = np.empty((len(y), horizon, 3))
            for h in range(horizon):
                t = reach + h
                clock = (pdf["origin_ts"] + pd.Timedelta(seconds=seconds * (h + 1))).dt
                means = [path[:, t - w : t].mean(axis=1) for w in windows]
                x = np.column_stack([path[:, t - lag_at], *means, clock.hour, clock.dayofweek]).astype(float)
                votes = trees.value.predict(x)
                path[:, t] = trees.value.combined(votes)
                out[:, h, 0] = path[:, t]
                out[:, h, 1:] = np.percentile(votes, [lo, hi], axis=1).T if trees.value.weights is None else np.nan
            yield pd.DataFrame(
                {
                    "series_id": np.repeat(pdf["series_id"].to_numpy(), horizon),
                    "origin_ts": np.repeat(pdf["origin_ts"].to_numpy(), horizon),
                    "h": np.tile(np.arange(1, horizon + 1), len(y)),
                    "yhat": out[:, :, 0].ravel(),
                    "lower": out[:, :, 1].ravel(),
                    "upper": out[:, :, 2].ravel(),
                }
            )

    schema = "series_id string, origin_ts timestamp_ntz, h bigint, yhat double, lower double, upper double"
    rows = newest.mapInPandas(extend, schema)
    rows = rows.withColumn("ts", grid_time(grid_index(F.col("origin_ts"), step) + F.col("h"), step))
    lower, upper = (F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("lower", "upper"))
    return shape_forecast(rows, ["series_id"], F.col("yhat"), lower, upper)


def forest_interval(model: PipelineModel, features: DataFrame, *, level: float = 0.95) -> DataFrame:
    """One-step mean and per-tree percentiles for rows whose features are known; score rows the model hasn't seen."""
    trees = features.sparkSession.sparkContext.broadcast(flatten_trees(features.sparkSession, model))
    lo, hi = (100 * p for p in level_probs(level))

    @F.pandas_udf("yhat double, lower double, upper double")
    def spread(x: pd.Series) -> pd.DataFrame:
        votes = trees.value.predict(np.stack(x.to_numpy()).astype(float))
        low, high = np.percentile(votes, [lo, hi], axis=1)
        return pd.DataFrame({"yhat": votes.mean(axis=1), "lower": low, "upper": high})

    rows = model.stages[0].transform(features.dropna()).withColumn("_p", spread(vector_to_array("features")))
    return rows.select("series_id", "ts", "y", "_p.yhat", "_p.lower", "_p.upper")
