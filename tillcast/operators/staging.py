"""Silver layer: types, precision and the NULL filter, nothing else."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.expressions import rounded, safe_date


def _date(raw: DataFrame) -> Column:
    """Raw dates are strings; a DATE column is taken as it is, which also keeps its partitioning."""
    typed = isinstance(raw.schema["date"].dataType, T.DateType)
    return F.col("date") if typed else safe_date("date").alias("date")


def stg_weather(raw: DataFrame) -> DataFrame:
    """The filter reads the raw columns: an unreadable date string passes it and becomes a NULL
    date, which the not-null test on the result reports."""
    kept = raw.filter(
        F.col("date").isNotNull() & F.col("temperature_max").isNotNull() & F.col("temperature_min").isNotNull()
    )
    return kept.select(
        _date(raw),
        "city",
        rounded("temperature_max").alias("temperature_max"),
        rounded("temperature_min").alias("temperature_min"),
        rounded("precipitation_sum").alias("precipitation_sum"),
        rounded("wind_speed_max").alias("wind_speed_max"),
        F.col("weather_code").cast("bigint").alias("weather_code"),
    )


def stg_sales(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    kept = raw.filter(F.col("date").isNotNull() & F.col("units_sold").isNotNull())
    numbers = ["units_sold", "snap_ca", "is_event", "day_of_week"]
    return kept.select(
        *keys, _date(raw), *[F.col(c).cast("bigint").alias(c) for c in numbers]
    )
