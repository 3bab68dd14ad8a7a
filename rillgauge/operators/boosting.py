"""Boosted regression trees with shrinkage and patience, on Spark ML's decision trees.

Spark's own boosting gives its first tree the full weight and ends at the first round that gains little. Here boosting starts from
the mean of the training rows, every tree is shrunk by the rate, and it ends when so many rounds in a row have not lowered the error on
the test rows; the best round is kept. The result is an ordinary ``GBTRegressionModel``: its first tree is the mean, a single leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from rillgauge.operators.sizing import broadcast_if_small
from rillgauge.session import discard, materialised


@dataclass(frozen=True)
class Boosting:
    """Settings: at most ``rounds`` trees; ``patience`` rounds without a better test error end the fit."""

    rounds: int = 1000
    rate: float = 0.05
    depth: int = 6
    bins: int = 256
    patience: int = 10
    seed: int = 42


@dataclass(frozen=True)
class Boosted:
    """A fitted model, the number of trees it keeps beside the mean, those grown, and the test errors (RMSE) from the mean on."""

    model: GBTRegressionModel
    rounds: int
    grown: int
    errors: list[float]


def ensemble(spark: SparkSession, trees: list, weights: list[float], features: str, output: str) -> GBTRegressionModel:
    """The model that adds up the trees by weight."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    kind = jvm.org.apache.spark.ml.regression
    held = gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(jvm.double, len(weights))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        held[i], shares[i] = tree._java_obj, float(weight)
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("gbtr")
    model = GBTRegressionModel(kind.GBTRegressionModel(uid, held, shares))
    return model.setFeaturesCol(features).setPredictionCol(output)


def fit(rows: DataFrame, settings: Boosting, features: str = "vector", target: str = "target", is_test: str = "is_test") -> Boosted:
    """Fit on the rows that are not ``is_test``; the others only decide which round is the best.

    There must be rows of both kinds. The predictions so far are written to the shared folder in every round, in which the error is
    measured too, so that a round does not depend on the plans of those before and survives the loss of an executor.
    """
    spark = rows.sparkSession
    own = rows.select(F.col(features).alias("vector"), F.col(target).cast("double").alias("target"), F.col(is_test).alias("is_test"))
    tree = DecisionTreeRegressor(
        featuresCol="vector", labelCol="residual", predictionCol="step", maxDepth=settings.depth, maxBins=settings.bins, seed=settings.seed
    )
    base = DecisionTreeRegressor(featuresCol="vector", labelCol="target", predictionCol="step", maxDepth=0, seed=settings.seed)

    def moved(state: DataFrame, model, share: float) -> tuple[DataFrame, float]:
        """The rows with the tree added to their predictions, and the error on the test rows."""
        added = model.transform(state).withColumn("prediction", F.col("prediction") + F.col("step") * share)
        left = added.withColumn("residual", F.col("target") - F.col("prediction")).select("vector", "target", "is_test", "prediction", "residual")
        seen = Observation()
        square = F.when(F.col("is_test"), F.col("residual") * F.col("residual"))
        table = materialised(left.observe(seen, F.sqrt(F.avg(square)).alias("error")), "boosted")
        return table, seen.get["error"]

    trees = [base.fit(own.where(~F.col("is_test")))]
    state, error = moved(own.withColumn("prediction", F.lit(0.0)), trees[0], 1.0)
    errors, best = [error], 0
    while len(trees) <= settings.rounds and len(errors) - 1 - best < settings.patience:
        trees.append(tree.fit(state.where(~F.col("is_test"))))
        after, error = moved(state, trees[-1], settings.rate)
        discard(state)
        state = after
        errors.append(error)
        if error < errors[best]:
            best = len(errors) - 1
    discard(state)
    weights = [1.0, *[settings.rate] * best]
    return Boosted(ensemble(spark, trees[: best + 1], weights, features, "prediction"), best, len(errors) - 1, errors)


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved model: ``tree``, ``weight``, ``node``, ``feature`` (null in leaves), ``threshold``, children, ``rows``, ``gain``, ``value``.

    ``gain`` is what the split lowers the sum of squared errors of its training rows by.
    """
    nodes = spark.read.parquet(f"{path}/data")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
    data, inner = F.col("nodeData"), F.col("nodeData.leftChild") >= 0
    rows = data["impurityStats"][0]
    return nodes.select(
        F.col("treeID").alias("tree"), data["id"].alias("node"), F.when(inner, data["split"]["featureIndex"]).alias("feature"),
        F.when(inner, data["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(inner, data["leftChild"]).alias("left"),
        F.when(inner, data["rightChild"]).alias("right"), rows.alias("rows"), F.when(inner, data["gain"] * rows).alias("gain"),
        data["prediction"].alias("value"),
    ).join(weights, "tree")


def split_importance(nodes: DataFrame, names: list[str]) -> DataFrame:
    """Per feature: ``weight`` (number of splits), ``gain`` (mean gain of a split) and ``importance`` (its share of all mean gains)."""
    listed = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    counts = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"))
    every = listed.join(counts, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce("weight", F.lit(0)).alias("weight"), F.coalesce("gain", F.lit(0.0)).alias("gain")
    )
    total = F.sum("gain").over(Window.partitionBy())
    share = F.when(total > 0, F.col("gain") / total).otherwise(F.lit(0.0))
    return every.select("feature", share.alias("importance"), "weight", "gain")


def recomputed(rows: DataFrame, nodes: DataFrame, names: list[str], key: Column, depth: int) -> DataFrame:
    """(``key``, ``recomputed``): predictions worked out from the stored nodes by following each tree down, a level at a time."""
    values = rows.select(key.alias("key"), F.array(*[F.col(n).cast("double") for n in names]).alias("x"))
    last = nodes.agg(F.max("tree").alias("last")).first().last
    # Every row meets every tree once; rows are bounded by the calendar, trees and their nodes by the rounds and the depth.
    at = values.select("key", "x", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("tree"), F.lit(0).alias("node"))
    steps = broadcast_if_small(nodes.select("tree", "weight", "node", "feature", "threshold", "left", "right", "value"))
    for _ in range(depth):
        down = F.when(F.col("feature").isNull(), F.col("node")).when(
            F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")
        ).otherwise(F.col("right"))
        at = at.join(steps, ["tree", "node"]).select("key", "x", "tree", down.alias("node"))
    return at.join(steps, ["tree", "node"]).groupBy("key").agg(F.sum(F.col("weight") * F.col("value")).alias("recomputed"))
