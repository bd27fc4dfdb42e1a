"""Forecast errors and the tables behind the charts. Input is the long form of
`operators.forecast`; every aggregate is combined map-side, so few models over many rows are fine."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.functions import expressions as ex


def forecast_metrics(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, MAPE and MAPE on anomaly days (NULL without any), in percent where a share.

    Days with an actual of 0 have no percentage error: they are left out of it and counted. Days without
    an actual or a prediction are not counted.
    """
    error = F.col("actual") - F.col("predicted")
    share = ex.relative_error("actual", "predicted")
    anomaly = F.col("anomaly_flag") == 1
    return long.groupBy(*keys, "model").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(share) * 100).alias("mape"),
        (F.avg(F.when(anomaly, share)) * 100).alias("anomaly_mape"),
        F.count(error).alias("days"),
        F.count_if(anomaly & error.isNotNull()).alias("anomaly_days"),
        F.count_if((F.col("actual") == 0) & error.isNotNull()).alias("zero_actual_days"),
    )


def model_summary(long: DataFrame, titles: dict[str, str] = fv.MODEL_TITLES) -> DataFrame:
    """Comparison table with report titles."""
    rank = ex.literal_map({model: i for i, model in enumerate(titles, 1)})
    title = ex.literal_map(titles)
    return forecast_metrics(long).select(
        F.element_at(rank, F.col("model")).alias("position"),
        F.element_at(title, F.col("model")).alias("title"),
        "rmse", "mae", "mape",
    )


def residuals(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long.select(*keys, "date", "model", (F.col("actual") - F.col("predicted")).alias("residual"))


def residual_stats(long: DataFrame) -> DataFrame:
    """Mean of actual - predicted; positive means the model forecasts too little."""
    return long.groupBy("model").agg(
        F.avg(F.col("actual") - F.col("predicted")).alias("mean_residual"),
        F.count(F.col("actual") - F.col("predicted")).alias("days"),
    )


def _per_model(long: DataFrame, **aggregates: Column) -> Column:
    """Aggregates per model as a one-row scalar subquery: map model -> struct. It holds one entry
    per model column, so the rows themselves need neither a join nor a shuffle on the model."""
    stats = long.groupBy("model").agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("stats"))
    return stats.agg(F.map_from_entries(F.collect_list(F.struct("model", "stats")))).scalar()


def residual_histogram(long: DataFrame, bins: int = fv.RESIDUAL_BINS) -> DataFrame:
    """All equal-width bins per model from the smallest to the largest residual, the last one closed. If
    all residuals are equal the range is one unit wide and they lie in its middle bin."""
    residual = F.col("actual") - F.col("predicted")
    rows = long.select("model", residual.cast("double").alias("residual")).filter("residual is not null")
    bounds = F.element_at(_per_model(rows, low=F.min("residual"), high=F.max("residual")), F.col("model"))
    wide = F.col("bounds.low") < F.col("bounds.high")
    low = F.when(wide, F.col("bounds.low")).otherwise(F.col("bounds.low") - 0.5)
    high = F.when(wide, F.col("bounds.high")).otherwise(F.col("bounds.high") + 0.5)
    position = F.least(F.width_bucket("residual", low, high, F.lit(bins)), F.lit(bins).cast("bigint"))
    # One count per bin, so that empty bins are there and the rows are combined per model.
    counts = [F.count_if(F.col("bin") == b).alias(f"bin{b}") for b in range(1, bins + 1)]
    days = F.array(*[f"bin{b}" for b in range(1, bins + 1)])
    return (
        rows.withColumn("bounds", bounds)
        .select("model", low.alias("low"), high.alias("high"), position.cast("int").alias("bin"))
        .groupBy("model", "low", "high").agg(*counts)
        .select("model", "low", "high", F.posexplode(days).alias("place", "days"))
        .select("model", (F.col("place") + 1).alias("bin"), "low", "high", "days")
    )


def scatter_bounds(long: DataFrame) -> DataFrame:
    """Ends of the identity line per model, and the MAPE of its title."""
    return long.groupBy("model").agg(
        F.least(F.min("actual"), F.min("predicted")).cast("double").alias("low"),
        F.greatest(F.max("actual"), F.max("predicted")).cast("double").alias("high"),
        (F.avg(ex.relative_error("actual", "predicted")) * 100).alias("mape"),
    )


def actual_vs_predicted(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long.select(*keys, "date", "model", "actual", "predicted")


def forecast_with_weather(
    forecasts: DataFrame, weather: DataFrame, keys: Sequence[str], weather_cols: Sequence[str], city: str = "city"
) -> DataFrame:
    """Forecast rows with the weather of their city and day. `city` names the forecast column that
    holds the city."""
    right = weather.select(F.col("city").alias("_city"), F.col("date").alias("_date"), *weather_cols)
    matched = (F.col(city) == F.col("_city")) & (F.col("date") == F.col("_date"))
    return forecasts.join(right, matched, "left").drop("_city", "_date")


def forecast_comparison(
    forecasts: DataFrame,
    weather: DataFrame,
    keys: Sequence[str],
    models: Sequence[str] = ("xgb_no_weather", "xgb_with_weather"),
    city: str = "city",
) -> DataFrame:
    """Actual, models, their absolute errors and the weather of the day."""
    cols = ["anomaly_flag", "weather_description", "temperature_max", "precipitation_sum"]
    joined = forecast_with_weather(forecasts, weather, keys, cols, city)
    errors = [ex.abs_error("actual_units_sold", m).alias(f"error_{m}") for m in models]
    return joined.select(*keys, "date", "actual_units_sold", *models, *errors, *cols)


def anomaly_days(comparison: DataFrame) -> DataFrame:
    """The highlighted days of the comparison with their label, e.g. `36°C Clear Sky`."""
    degrees = F.format_string("%.0f°C", F.bround("temperature_max", 0))
    label = F.concat_ws(" ", degrees, "weather_description")
    return comparison.filter(F.col("anomaly_flag") == 1).withColumn("label", label)


def worst_days(
    forecasts: DataFrame,
    weather: DataFrame,
    keys: Sequence[str],
    model: str = "xgb_no_weather",
    k: int = 20,
    city: str = "city",
) -> DataFrame:
    """The `k` largest absolute errors with the weather of the day; ties by date, then series."""
    cols = [
        "temperature_max", "precipitation_sum", "anomaly_flag", "is_extreme_heat", "is_heavy_rain",
        "weather_description",
    ]
    # Weather cannot change the ranking, so it is joined to the k rows only.
    error = ex.abs_error("actual_units_sold", model).alias("error")
    worst = (
        forecasts.select(*dict.fromkeys([*keys, city]), "date", "actual_units_sold", model, error)
        .orderBy(F.col("error").desc_nulls_last(), "date", *keys)
        .limit(k)
    )
    joined = forecast_with_weather(worst, weather, keys, cols, city)
    return joined.select(*keys, "date", "actual_units_sold", model, "error", *cols)

