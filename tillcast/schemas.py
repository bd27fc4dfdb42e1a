"""Declared table layouts. Reading with a schema does not enforce nullability in Spark, so
required columns are listed separately and checked by `operators.quality`."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_S, _F, _D, _I, _L = T.StringType(), T.FloatType(), T.DoubleType(), T.IntegerType(), T.LongType()

CALENDAR = _struct(
    ("date", _S, True), ("wday", _I, True), ("event_name_1", _S, True), ("snap_CA", _I, True),
)

WEATHER_PAYLOAD = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(_S)),
        T.StructField("temperature_2m_max", T.ArrayType(_D)),
        T.StructField("temperature_2m_min", T.ArrayType(_D)),
        T.StructField("precipitation_sum", T.ArrayType(_D)),
        T.StructField("wind_speed_10m_max", T.ArrayType(_D)),
        T.StructField("weather_code", T.ArrayType(_I)),
    ])),
])

BRONZE_WEATHER = _struct(
    ("date", _S, False), ("city", _S, False),
    ("temperature_max", _F, False), ("temperature_min", _F, False),
    ("precipitation_sum", _F, True), ("wind_speed_max", _F, True), ("weather_code", _I, True),
)
BRONZE_SALES = _struct(
    ("date", _S, False), ("units_sold", _L, False),
    ("snap_ca", _L, True), ("is_event", _L, True), ("day_of_week", _L, True),
)
RAW_WEATHER = _struct(
    ("date", _S, False), ("city", _S, False),
    ("temperature_max", _D, False), ("temperature_min", _D, False),
    ("precipitation_sum", _D, True), ("wind_speed_max", _D, True), ("weather_code", _L, True),
)
RAW_SALES = BRONZE_SALES

WEATHER_MART_COLUMNS = [
    "date", "city", "temperature_max", "temperature_min", "precipitation_sum", "wind_speed_max",
    "weather_code", "temperature_range", "rolling_avg_temp_7d", "temp_lag_3", "temp_lag_7", "season",
    "is_extreme_heat", "is_heavy_rain", "weather_description", "anomaly_flag",
]
# Weather columns that the demand table carries.
DEMAND_WEATHER_COLUMNS = [
    "temperature_max", "temperature_min", "precipitation_sum", "anomaly_flag", "rolling_avg_temp_7d",
    "is_extreme_heat", "is_heavy_rain", "weather_code", "weather_description", "season",
    "temp_lag_3", "temp_lag_7",
]
SALES_COLUMNS = ["date", "units_sold", "snap_ca", "is_event", "day_of_week"]


def keyed(schema: T.StructType, keys) -> T.StructType:
    """`schema` with required string series keys in front of it."""
    extra = [T.StructField(k, _S, False) for k in keys if k not in schema.fieldNames()]
    return T.StructType(extra + schema.fields)


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
