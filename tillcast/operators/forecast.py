"""The five forecasts side by side, in long form keyed by series and date."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.operators.boosted import forecast_boosted
from tillcast.operators.features import is_train
from tillcast.operators.seasonal import forecast_seasonal
from tillcast.operators.windows import whole_series
from tillcast.session import at_once, cut_lineage


def last_train_value(keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF) -> Column:
    train = is_train(cutoff)
    last = F.max_by(F.when(train, F.col("units_sold")), F.when(train, F.col("date")))
    return last.over(whole_series(keys))


def forecast_naive(df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF) -> DataFrame:
    """The last training value, constant over all test days of the series."""
    with_last = df.withColumn("prediction", last_train_value(keys, cutoff).cast("double"))
    return with_last.filter(~is_train(cutoff)).select(*keys, "date", "prediction")


def to_long(wide: DataFrame, keys: Sequence[str], models: Sequence[str], actual: str = "actual_units_sold") -> DataFrame:
    """Forecast table -> one row per series, date and model."""
    extra = [c for c in ("anomaly_flag",) if c in wide.columns]
    ready = wide.select(
        *keys, "date", F.col(actual).alias("actual"), *extra,
        *[F.col(m).cast("double").alias(m) for m in models],
    )
    return ready.unpivot([*keys, "date", "actual", *extra], list(models), "model", "predicted")


def forecast_all(
    features: DataFrame,
    keys: Sequence[str],
    cutoff: str = fv.TRAIN_TEST_CUTOFF,
    n_trees: int = fv.BOOSTED_TREES,
) -> tuple[DataFrame, GBTRegressionModel]:
    """(keys, date, model, actual, predicted, anomaly_flag) of all five models, and the boosted
    weather model. Predictions meet the actuals by key, never by row position."""
    features = cut_lineage(features)
    # A training is thousands of tiny jobs one after the other, so both run at once.
    trained = at_once(
        features.sparkSession,
        boosted=lambda: forecast_boosted(features, keys, fv.BASE_FEATURES, cutoff, n_trees),
        boosted_weather=lambda: forecast_boosted(features, keys, fv.WEATHER_FEATURES, cutoff, n_trees),
    )
    (boosted, _), (boosted_weather, model) = trained["boosted"], trained["boosted_weather"]
    predictions = dict(zip(fv.MODEL_TITLES, [
        forecast_naive(features, keys, cutoff),
        forecast_seasonal(features, keys, cutoff),
        forecast_seasonal(features, keys, cutoff, fv.WEATHER_REGRESSORS),
        boosted,
        boosted_weather,
    ]))
    return collect_predictions(features, predictions, keys, cutoff), model


def collect_predictions(
    features: DataFrame, predictions: Mapping[str, DataFrame], keys: Sequence[str], cutoff: str
) -> DataFrame:
    """Predictions per model (keys, date, prediction) + the test rows -> long form.

    The models are stacked before the one join with the actuals. A test day for which a model has no
    prediction stays, with NULL.
    """
    stacked = reduce(DataFrame.unionByName, [
        p.select(*keys, "date", F.lit(name).alias("model"), F.col("prediction").alias("predicted"))
        for name, p in predictions.items()
    ])
    actuals = features.filter(~is_train(cutoff)).select(
        *keys, "date", F.col("units_sold").alias("actual"), "anomaly_flag"
    )
    models = F.explode(F.array(*[F.lit(name) for name in predictions])).alias("model")
    return actuals.select("*", models).join(stacked, [*keys, "date", "model"], "left").select(
        *keys, "date", "model", "actual", "predicted", "anomaly_flag"
    )
