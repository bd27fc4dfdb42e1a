"""Recommendation context, prompt text and generated text per series and day."""

import re
import time
from collections.abc import Callable, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.functions import expressions as ex
from tillcast.operators.evaluate import forecast_with_weather
from tillcast.session import cut_lineage
from tillcast.sources.files import has_files

CONTEXT_WEATHER = [
    "temperature_max", "precipitation_sum", "anomaly_flag", "weather_description", "season",
    "is_extreme_heat", "is_heavy_rain",
]
CONTEXT_DEMAND = ["snap_ca", "is_event", "day_of_week", "sales_rolling_avg_7d"]


def available_dates(forecasts: DataFrame) -> DataFrame:
    """First and last date and how many different days there are, over all series."""
    return forecasts.agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"), F.count_distinct("date").alias("total_days")
    )


def parse_dates(selection: str) -> list[date]:
    """Dates of a comma list. Anything not spelled YYYY-MM-DD can never equal a stored date."""
    found = []
    for part in selection.split(","):
        text = part.strip()
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
            try:
                found.append(date.fromisoformat(text))
            except ValueError:
                continue
    return found


def for_dates(df: DataFrame, dates: Sequence[date]) -> DataFrame:
    return df.filter(F.col("date").isin(list(dates)))


def resolve_dates(
    selection: str, forecasts: DataFrame, weather: DataFrame, demand: DataFrame, keys: Sequence[str], city: str = "city"
) -> DataFrame:
    """Series and dates to write about: 'anomaly', 'snap' (first five days of each series) or a
    comma list of dates. Keywords in any case."""
    word = selection.strip().lower()
    days = forecasts.select(*dict.fromkeys([*keys, city]), "date")
    if word == "anomaly":
        joined = forecast_with_weather(days, weather, keys, ["anomaly_flag"], city)
        chosen = joined.filter(F.col("anomaly_flag") == 1)
    elif word == "snap":
        snap = days.join(demand.select(*keys, "date", "snap_ca"), [*keys, "date"], "left")
        first = F.row_number().over(Window.partitionBy(*keys).orderBy("date"))
        snap = snap.filter(F.col("snap_ca") == 1).withColumn("_n", first)
        chosen = snap.filter(F.col("_n") <= fv.SNAP_DAYS_SHOWN)
    else:
        chosen = for_dates(days, parse_dates(selection))
    return chosen.select(*keys, "date")


def recommendation_context(
    forecasts: DataFrame,
    weather: DataFrame,
    demand: DataFrame,
    keys: Sequence[str],
    dates: DataFrame | None = None,
    model: str = "xgb_with_weather",
    city: str = "city",
) -> DataFrame:
    """Forecast, error, weather and calendar of each day; `dates` (keys, date) restricts the days
    before anything is joined."""
    if dates is not None:
        forecasts = forecasts.join(dates, [*keys, "date"], "left_semi")
    base = forecasts.select(
        *dict.fromkeys([*keys, city]), "date", "actual_units_sold",
        F.col(model).alias("forecasted_units"),
        ex.error_pct("actual_units_sold", model).alias("error_pct"),
    )
    joined = forecast_with_weather(base, weather, keys, CONTEXT_WEATHER, city)
    calendar = demand.select(*keys, "date", *CONTEXT_DEMAND)
    return joined.join(calendar, [*keys, "date"], "left").select(
        *dict.fromkeys([*keys, city]), "date", "actual_units_sold", "forecasted_units", "error_pct",
        *CONTEXT_WEATHER, *CONTEXT_DEMAND,
    )


def _truth(name: str) -> Column:
    return F.when(F.col(name) != 0, "True").when(F.col(name) == 0, "False").otherwise(fv.UNKNOWN_LABEL)


def _text(value: Column, missing: str) -> Column:
    return F.coalesce(value.cast("string"), F.lit(missing))


def with_prompt(
    df: DataFrame, store: str | Column = "store_id", department: str | Column = "cat_id", city: str | Column = "city"
) -> DataFrame:
    """Adds the prompt column to context rows; each text names the store, department and city of its row."""
    change = ex.demand_vs_average_pct("forecasted_units", "sales_rolling_avg_7d")
    places = [F.col(c) if isinstance(c, str) else c for c in (store, department, city)]
    parts = [
        *[_text(c, fv.UNKNOWN_LABEL) for c in places],
        F.date_format("date", "yyyy-MM-dd"),
        ex.day_name("day_of_week"),
        _text(ex.whole_units("forecasted_units"), fv.UNKNOWN_LABEL),
        _text(ex.whole_units("actual_units_sold"), fv.UNKNOWN_LABEL),
        ex.fixed_1dp(change, plus=True),
        _text(F.col("temperature_max").cast("double"), "nan"),
        _text(F.col("precipitation_sum").cast("double"), "nan"),
        _text(F.col("weather_description"), "None"),
        _text(F.col("season"), "None"),
        *[_truth(c) for c in ("anomaly_flag", "is_extreme_heat", "is_heavy_rain", "snap_ca", "is_event")],
    ]
    return df.withColumn("prompt", F.format_string(fv.PROMPT_TEMPLATE, *parts))


def headline(df: DataFrame) -> DataFrame:
    """The printed lines above each recommendation: units and error, weather, flags."""
    units = F.format_string(
        "Forecast: %s units | Actual: %s units | Error: %s%%",
        _text(ex.whole_units("forecasted_units"), fv.UNKNOWN_LABEL),
        _text(ex.whole_units("actual_units_sold"), fv.UNKNOWN_LABEL),
        _text(ex.fixed_1dp("error_pct"), "nan"),
    )
    weather = F.format_string(
        "Weather: %s°C, %s",
        _text(F.col("temperature_max").cast("double"), "nan"),
        _text(F.col("weather_description"), "None"),
    )
    flags = F.format_string(
        "Anomaly: %s | SNAP: %s | Event: %s", *[_truth(c) for c in ("anomaly_flag", "snap_ca", "is_event")]
    )
    return df.withColumn("headline", F.concat_ws("\n", units, weather, flags))


def _answered(df: DataFrame, fn: Callable[[str], str], retries: int, wait: float, parallelism: int | None) -> DataFrame:
    """Adds `answer` (text, ok) to rows with a prompt. The calls are slow and few compared with the rows of any other
    stage, and a join of few rows leaves few tasks, so they are spread over `parallelism` tasks, by default as many
    as the session runs at a time. Only the prompt column travels to Python."""

    def attempt(prompt: str | None) -> tuple[str | None, bool]:
        for number in range(1, retries + 1):
            try:
                return (None if prompt is None else fn(prompt)), True
            except Exception as error:
                if number == retries:
                    return fv.UNAVAILABLE_TEXT.format(error=error), False
                time.sleep(wait)

    @F.pandas_udf("text string, ok boolean")
    def answers(prompts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([attempt(p) for p in prompts], columns=["text", "ok"])

    df = df.repartition(parallelism or df.sparkSession.sparkContext.defaultParallelism)
    # Non-deterministic, so the optimizer neither repeats a call nor moves it.
    return df.withColumn("answer", answers.asNondeterministic()("prompt"))


def generate(
    df: DataFrame,
    fn: Callable[[str], str],
    retries: int = fv.GENERATION_ATTEMPTS,
    wait: float = fv.GENERATION_PAUSE_SECONDS,
    parallelism: int | None = None,
) -> DataFrame:
    """Adds `recommendation = fn(prompt)`. After the last failed attempt the text says so instead."""
    answered = _answered(df, fn, retries, wait, parallelism)
    return answered.withColumn("recommendation", F.col("answer.text")).drop("answer")


def generate_stored(
    df: DataFrame,
    fn: Callable[[str], str],
    store: str,
    retries: int = fv.GENERATION_ATTEMPTS,
    wait: float = fv.GENERATION_PAUSE_SECONDS,
    parallelism: int | None = None,
) -> DataFrame:
    """`generate` with the answers kept below `store`, keyed by a hash of the prompt. Equal prompts are asked once; what
    an earlier run stored is not asked again. A run's calls end in a checkpoint, so later stages cannot repeat one, and
    are appended to the store. Failed calls are not stored: the next run tries them again."""
    spark, key = df.sparkSession, F.sha2("prompt", 256).alias("prompt_hash")
    known = spark.createDataFrame([], "prompt_hash string, recommendation string")
    if has_files(spark, store):
        known = spark.read.schema(known.schema).parquet(store)
    asked = df.filter(F.col("prompt").isNotNull()).select(key, "prompt").distinct()
    open_prompts = asked.join(known, "prompt_hash", "left_anti")
    fresh = cut_lineage(_answered(open_prompts, fn, retries, wait, parallelism).select("prompt_hash", "answer.*"))
    fresh.filter("ok").select("prompt_hash", F.col("text").alias("recommendation")).write.mode("append").parquet(store)
    answers = known.union(fresh.select("prompt_hash", "text")).groupBy("prompt_hash").agg(F.min("recommendation").alias("recommendation"))
    return df.withColumn("prompt_hash", key).join(answers, "prompt_hash", "left").drop("prompt_hash")
