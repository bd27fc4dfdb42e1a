"""Boosted regression trees: one model over all series, trained on the cluster by MLlib."""

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.functions.expressions import feature_group
from tillcast.operators.features import fill_zero, is_train
from tillcast.session import cut_lineage, shared_folder


ROWS_PER_PARTITION = 50_000


def feature_frame(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF
) -> DataFrame:
    """Keys, target, split and one feature vector; gaps are 0."""
    filled = fill_zero(df, features).select(
        *keys,
        "date",
        F.col("units_sold").cast("double").alias("label"),
        is_train(cutoff).alias("train"),
        *[F.col(f).cast("double").alias(f) for f in features],
    )
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)
    return vectors.select(*keys, "date", "label", "train", "features")


def forecast_boosted(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] = tuple(fv.WEATHER_FEATURES),
    cutoff: str = fv.TRAIN_TEST_CUTOFF,
    n_trees: int = fv.BOOSTED_TREES,
) -> tuple[DataFrame, GBTRegressionModel]:
    """Predictions for the test days, and the model.

    The feature frame is read by training and by prediction; a checkpoint makes that one
    evaluation, cuts its lineage and survives lost executors. MLlib checkpoints between trees too. Trees
    grow one after the other, each with a few jobs, so training reads no more partitions than its rows
    fill.
    """
    frame = cut_lineage(feature_frame(df, keys, features, cutoff))
    train = frame.filter("train").select("label", "features")
    train = train.coalesce(-(-train.count() // ROWS_PER_PARTITION) or 1)
    booster = GBTRegressor(
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        maxIter=n_trees,
        stepSize=fv.BOOSTED_LEARNING_RATE,
        maxDepth=fv.BOOSTED_DEPTH,
        subsamplingRate=fv.BOOSTED_SUBSAMPLE,
        seed=fv.BOOSTED_SEED,
        maxBins=256,
        cacheNodeIds=False,
    )
    model = booster.fit(train)
    return model.transform(frame.filter(~F.col("train"))).select(*keys, "date", "prediction"), model


def feature_importance(df: DataFrame, model: GBTRegressionModel, features: Sequence[str]) -> DataFrame:
    """One row per feature: importance (sums to 1), its chart group, and its rank from the most important
    one; read upwards it is the table in ascending importance. It has a row per feature, no more."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    rank = F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature"))
    return table.select("*", feature_group("feature").alias("feature_group"), rank.alias("rank"))


def top_features(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.filter(F.col("rank") <= k).orderBy("rank")


def tree_nodes(model: GBTRegressionModel, spark: SparkSession) -> DataFrame:
    """The forest as a table: tree, node, feature (position, NULL at a leaf), gain, rows. It is written with the model."""
    folder = shared_folder(spark, "boosted-trees")
    model.write().save(folder)
    node = F.col("nodeData")
    feature = node["split"]["featureIndex"]
    return spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(feature >= 0, feature).alias("feature"),
        node["gain"].alias("gain"), node["impurityStats"][0].alias("rows"),
    )


def importance_from_nodes(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """`feature_importance` from the trees themselves: the gains of a feature's splits, weighted by the rows that each
    split has, as a share of all; with a row for each feature."""
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "position int, feature string")
    weight = nodes.filter("feature is not null").groupBy(F.col("feature").alias("position")).agg(
        F.sum(F.col("gain") * F.col("rows")).alias("weight")
    )
    every = Window.partitionBy()
    share = F.try_divide(F.coalesce("weight", F.lit(0.0)), F.sum("weight").over(every))
    table = names.join(weight, "position", "left").select("feature", F.coalesce(share, F.lit(0.0)).alias("importance"))
    rank = F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature"))
    return table.select("*", feature_group("feature").alias("feature_group"), rank.alias("rank"))
