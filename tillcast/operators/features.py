"""Model features. Rows keep their series keys and date; the split is a date, not a second frame, so
one plan with one shuffle carries training and test rows together."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.functions import expressions as ex
from tillcast.operators.windows import by_month, lag_feature, lead_feature, whole_series


def is_train(cutoff: str) -> Column:
    return F.col("date") < F.lit(cutoff).cast("date")


def split_by_date(df: DataFrame, cutoff: str = fv.TRAIN_TEST_CUTOFF) -> tuple[DataFrame, DataFrame]:
    return df.filter(is_train(cutoff)), df.filter(~is_train(cutoff))


def drop_warmup(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["sales_lag_7", "sales_lag_14"])


def lead_features(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Next day's weather, standing in for a weather forecast; NULL on the last day of a series."""
    return df.withColumns({
        "tomorrow_temp": lead_feature("temperature_max", 1, keys),
        "tomorrow_precipitation": lead_feature("precipitation_sum", 1, keys),
        "tomorrow_extreme_heat": lead_feature("is_extreme_heat", 1, keys),
        "tomorrow_heavy_rain": lead_feature("is_heavy_rain", 1, keys),
    })


def temp_change(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(f"temp_change_{n}d", F.col("temperature_max") - lag_feature("temperature_max", n, keys))


def prepare_features(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Warm-up rows go first, so the temperature change starts three rows after them."""
    return temp_change(lead_features(drop_warmup(df), keys), 3, keys)


def monthly_baseline(df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF) -> DataFrame:
    """Mean daily maximum per series and month, training rows only."""
    return (
        df.filter(is_train(cutoff))
        .groupBy(*keys, F.month("date").alias("month"))
        .agg(F.avg(ex.exact("temperature_max")).cast("double").alias("monthly_mean_temp"))
    )


def add_weather_shocks(
    df: DataFrame,
    keys: Sequence[str],
    cutoff: str = fv.TRAIN_TEST_CUTOFF,
    use_weather_code: bool = True,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Deviation from the training months, heat flag and deterrence score.

    The training mean is a conditional window over rows that are already together, so it costs no
    join. A stored `baseline` can be joined instead, to score days without their training history.
    `use_weather_code=False` is the chart variant of the score.
    """
    month = F.month("date")
    if baseline is None:
        train_temp = F.when(is_train(cutoff), ex.exact("temperature_max"))
        mean = F.avg(train_temp).over(by_month(keys)).cast("double")
        df = df.withColumns({"month": month, "_mean": mean})
    else:
        means = baseline.withColumnRenamed("monthly_mean_temp", "_mean")
        df = df.withColumn("month", month).join(means, [*keys, "month"], "left")
    df = df.withColumn("temp_anomaly_from_monthly", F.col("temperature_max") - F.col("_mean")).drop("_mean")
    code = "weather_code" if use_weather_code else None
    return df.withColumns({
        "unseasonable_heat": ex.unseasonable_heat("temp_anomaly_from_monthly"),
        "shopping_deterrence": ex.shopping_deterrence("precipitation_sum", "temperature_max", code),
    })


def train_medians(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] = tuple(fv.WEATHER_REGRESSORS),
    cutoff: str = fv.TRAIN_TEST_CUTOFF,
) -> DataFrame:
    """Exact, interpolating median per series; a series is bounded by its days."""
    train = df.filter(is_train(cutoff))
    return train.groupBy(*keys).agg(*[F.median(c).alias(c) for c in cols])


def impute_median(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] = tuple(fv.WEATHER_REGRESSORS),
    cutoff: str = fv.TRAIN_TEST_CUTOFF,
) -> DataFrame:
    """Fills gaps of training and test rows with the training median, and makes the columns double."""
    median = {c: F.median(F.when(is_train(cutoff), F.col(c))).over(whole_series(keys)) for c in cols}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), median[c]) for c in cols})


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.fill(0, list(cols))


def model_features(
    demand: DataFrame,
    keys: Sequence[str],
    cutoff: str = fv.TRAIN_TEST_CUTOFF,
    impute: bool = True,
    use_weather_code: bool = True,
) -> DataFrame:
    """Demand table -> everything the five models read.

    With `impute` the seven regressors are median-filled for all models that follow; without it the
    boosted model only zero-fills. The chart run does so, with a deterrence score that leaves out the
    weather code: `impute=False, use_weather_code=False`.
    """
    df = add_weather_shocks(prepare_features(demand, keys), keys, cutoff, use_weather_code)
    return impute_median(df, keys, cutoff=cutoff) if impute else df


def split_series(df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF) -> DataFrame:
    label = F.when(is_train(cutoff), "train").otherwise("test")
    return df.filter(F.col("date").isNotNull()).select(*keys, "date", "units_sold", label.alias("split"))


def split_counts(df: DataFrame, cutoff: str = fv.TRAIN_TEST_CUTOFF, keys: Sequence[str] = ()) -> DataFrame:
    return (
        split_series(df, keys, cutoff)
        .groupBy(*keys, "split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
    )
