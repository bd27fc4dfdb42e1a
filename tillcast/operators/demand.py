"""Gold demand table: sales joined to weather, with sales history."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.operators.windows import lag_feature, rolling_avg

# (sales column, weather column) pairs of the join.
CITY_AND_DATE = (("city", "city"), ("date", "date"))


def attach_city(sales: DataFrame, store_city: DataFrame) -> DataFrame:
    """Adds the store's city. Stores without one keep their sales and get no weather."""
    return sales.join(store_city.select("store_id", "city"), "store_id", "left")


def join_weather(
    sales: DataFrame, weather: DataFrame, keys: Sequence[str], on: Sequence[tuple[str, str]] = CITY_AND_DATE
) -> DataFrame:
    """Every sales row, with the weather of its place and day or NULLs.

    Place and date together are the key: a date alone would repeat each sale once per city.
    """
    right = weather.select(
        *[F.col(w).alias(f"_w_{w}") for _, w in on], *schemas.DEMAND_WEATHER_COLUMNS
    )
    condition = [F.col(s) == F.col(f"_w_{w}") for s, w in on]
    return sales.join(right, condition, "left").select(
        *keys, *schemas.SALES_COLUMNS, *schemas.DEMAND_WEATHER_COLUMNS
    )


def with_sales_lags(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({
        "sales_lag_7": lag_feature("units_sold", 7, keys),
        "sales_lag_14": lag_feature("units_sold", 14, keys),
    })


def with_sales_rolling(df: DataFrame, keys: Sequence[str], include_current: bool = True) -> DataFrame:
    return df.withColumns({
        "sales_rolling_avg_7d": rolling_avg("units_sold", 7, keys, include_current=include_current),
        "sales_rolling_avg_14d": rolling_avg("units_sold", 14, keys, include_current=include_current),
    })


def mart_demand_features(
    sales: DataFrame,
    weather: DataFrame,
    keys: Sequence[str],
    on: Sequence[tuple[str, str]] = CITY_AND_DATE,
    include_current: bool = True,
) -> DataFrame:
    """`sales` holds the series keys and the place columns named in `on`.

    The rolling means contain the day itself, as published; `include_current=False` gives features
    that a real forecast could know.
    """
    joined = join_weather(sales, weather, keys, on)
    return with_sales_rolling(with_sales_lags(joined, keys), keys, include_current)


def densify_dates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row for every calendar day from a series' first to its last one, NULL where `df` has none, so that windows over
    rows become windows over days. Rows without a date drop out. A series' days come from its range alone."""
    span = df.groupBy(*keys).agg(F.min("date").alias("_first"), F.max("date").alias("_last")).filter("_first is not null")
    days = span.select(
        *[F.col(k).alias(f"_d_{k}") for k in keys],
        F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias("_day"),
    )
    same = [F.col(f"_d_{k}").eqNullSafe(F.col(k)) for k in keys] + [F.col("_day") == F.col("date")]
    own = {**{k: F.col(f"_d_{k}").alias(k) for k in keys}, "date": F.col("_day").alias("date")}
    return days.join(df, same, "left").select(*[own.get(c, F.col(c)) for c in df.columns])
