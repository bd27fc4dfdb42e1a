"""Gold weather table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast import schemas
from tillcast.functions import expressions as ex
from tillcast.operators.windows import by_month, lag_feature, rolling_avg


def temperature_range() -> Column:
    return F.round(F.col("temperature_max") - F.col("temperature_min"), 1)


def monthly_stats(df: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Mean and sample deviation of the daily maximum per city and month of the year."""
    return df.groupBy(*keys, F.month("date").alias("month")).agg(
        F.avg(ex.exact("temperature_max")).cast("double").alias("monthly_avg_temp"),
        F.stddev_samp("temperature_max").alias("monthly_stddev_temp"),
    )


def anomaly_flag(keys: Sequence[str] = ("city",)) -> Column:
    """1 when the day is more than two deviations from its month; 0 while the deviation is NULL."""
    mean = F.avg(ex.exact("temperature_max")).over(by_month(keys)).cast("double")
    deviation = F.stddev_samp("temperature_max").over(by_month(keys))
    return ex.flag(F.abs(F.col("temperature_max") - mean) > deviation * fv.ANOMALY_STDDEVS)


def with_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "temperature_range": temperature_range(),
        "season": ex.season("date"),
        "is_extreme_heat": ex.is_extreme_heat("temperature_max"),
        "is_heavy_rain": ex.is_heavy_rain("precipitation_sum"),
        "weather_description": ex.weather_label("weather_code"),
    })


def with_history(df: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    return df.withColumns({
        "rolling_avg_temp_7d": rolling_avg(ex.exact("temperature_max"), 7, keys),
        "temp_lag_3": lag_feature("temperature_max", 3, keys),
        "temp_lag_7": lag_feature("temperature_max", 7, keys),
    })


def mart_weather_daily(stg: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Features per city and day. One shuffle on the city serves the dated and the monthly windows."""
    features = with_history(with_labels(stg), keys).withColumn("anomaly_flag", anomaly_flag(keys))
    return features.select(*schemas.WEATHER_MART_COLUMNS)
