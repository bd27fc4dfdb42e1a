"""The whole batch job in dependency order: bronze, raw, silver, gold, forecast, recommendation.

Every stage ends in a written file or table and the next one reads it, so a lost executor or a failed
stage repeats one stage only. Bronze is laid out in a bounded number of folders, and a run replaces the cities and series
that it brings; all later tables are built from everything in bronze. So running twice equals running once, and a run for
one city or series keeps the others. Silver and gold frames pass their data tests before they replace a table.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast import schemas
from tillcast.operators import demand, evaluate, features, forecast, quality, recommend, reshape, staging, weather
from tillcast.session import cut_lineage
from tillcast.sources import files, tables

CITY = ["city"]


@dataclass(frozen=True)
class Job:
    """Inputs and settings of a run.

    `root` is the folder of the bronze layer. `city` names the one city of `weather_json`; without it
    the folder holds `city=<name>/` subfolders. `store_city` (store_id, city) places the stores; with
    one city it may be left out. `series` limits the run to (store_id, cat_id). `parallelism` is the number
    of tasks that call `answer`, by default as many as the session runs at a time; `answers` is a folder that keeps what
    it returned, so that no run asks for a text twice. `prefix` goes before the names of the databases.
    """

    spark: SparkSession
    root: str
    sales_csv: str
    calendar_csv: str
    weather_json: str
    city: str | None = None
    store_city: DataFrame | None = None
    series: tuple[str, str] | None = None
    keys: Sequence[str] = ("store_id", "cat_id")
    cutoff: str = fv.TRAIN_TEST_CUTOFF
    n_trees: int = fv.BOOSTED_TREES
    selection: str = "anomaly"
    answer: Callable[[str], str] | None = None
    retries: int = fv.GENERATION_ATTEMPTS
    wait: float = fv.GENERATION_PAUSE_SECONDS
    parallelism: int | None = None
    answers: str | None = None
    prefix: str = ""
    written: list = field(default_factory=list)

    def table(self, layer: str, name: str) -> DataFrame:
        return tables.table(self.spark, layer, name, self.prefix)

    def save(self, df: DataFrame, layer: str, name: str, keys: Sequence[str]) -> None:
        self.written.append(tables.materialize(df, layer, name, sort_by=[*keys, "date"], prefix=self.prefix))

    def bronze(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/bronze/{name}"

    def places(self, stores: DataFrame) -> DataFrame:
        """The city of each of these stores."""
        if self.store_city is not None:
            known = self.store_city.select("store_id", "city").join(stores.select("store_id").distinct(), "store_id", "left_semi")
            twice = known.groupBy("store_id").count().filter("count > 1").select("store_id").limit(5).collect()
            if twice:
                raise ValueError(f"stores placed twice: {', '.join(sorted(r.store_id for r in twice))}")
            return known
        if self.city is None:
            raise ValueError("several cities need a store_city table")
        return stores.select("store_id").distinct().withColumn("city", F.lit(self.city))

    def placed(self, df: DataFrame) -> DataFrame:
        """`df` with the city of each store, also of stores that earlier runs brought."""
        known = self.spark.read.schema("city string, store_id string").parquet(self.bronze("places")).select("city", "store_id")
        return demand.attach_city(df, known)


def ingest_weather(job: Job) -> None:
    rows = files.read_weather_json(job.spark, job.weather_json, job.city)
    # The guard rides along with the write: the landing folder is read once.
    required = schemas.required(schemas.BRONZE_WEATHER)
    bronze = quality.guard_not_null(quality.conform(rows, schemas.BRONZE_WEATHER), required)
    tables.write_bronze(bronze, job.bronze("weather"), CITY)


def load_weather(job: Job) -> None:
    bronze = files.read_bronze(job.spark, job.bronze("weather"), schemas.RAW_WEATHER)
    job.save(quality.conform(bronze, schemas.RAW_WEATHER), "weather_raw", "weather_raw_daily", CITY)


def ingest_sales(job: Job) -> None:
    wide = files.read_sales_wide(job.spark, job.sales_csv)
    if job.series:
        wide = reshape.filter_series(wide, *job.series)
    daily = reshape.daily_sales(wide, files.read_calendar(job.spark, job.calendar_csv), job.keys)
    schema = schemas.keyed(schemas.BRONZE_SALES, job.keys)
    # The guard rides along with the one pass over the matrix.
    bronze = cut_lineage(quality.guard_not_null(quality.conform(daily, schema), schemas.required(schema)))
    tables.write_bronze(bronze, job.bronze("sales"), job.keys)
    tables.write_bronze(job.places(bronze), job.bronze("places"), ["store_id"], buckets=1)


def load_sales(job: Job) -> None:
    schema = schemas.keyed(schemas.RAW_SALES, job.keys)
    bronze = files.read_bronze(job.spark, job.bronze("sales"), schema)
    job.save(quality.conform(bronze, schema), "sales_raw", "sales_raw_daily", job.keys)


def _publish(job: Job, layer: str, frames: dict[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Evaluates and tests the frames, then writes them: a failing test leaves the old tables in place."""
    ready = {name: (cut_lineage(df), keys) for name, (df, keys) in frames.items()}
    tests = quality.standard_tests(job.keys, CITY)
    quality.require_checks(quality.run_checks({name: df for name, (df, _) in ready.items()}, tests))
    for name, (df, keys) in ready.items():
        job.save(df, layer, name, keys)


def build_silver(job: Job) -> None:
    _publish(job, "staging", {
        "stg_weather": (staging.stg_weather(job.table("weather_raw", "weather_raw_daily")), CITY),
        "stg_sales": (staging.stg_sales(job.table("sales_raw", "sales_raw_daily"), job.keys), job.keys),
    })


def build_gold(job: Job) -> None:
    wx = cut_lineage(weather.mart_weather_daily(job.table("staging", "stg_weather")))
    mart = demand.mart_demand_features(job.placed(job.table("staging", "stg_sales")), wx, job.keys)
    _publish(job, "marts", {"mart_weather_daily": (wx, CITY), "mart_demand_features": (mart, job.keys)})


def build_forecasts(job: Job) -> DataFrame:
    """Writes the forecasts and returns the comparison of the models."""
    ready = features.model_features(job.table("marts", "mart_demand_features"), job.keys, job.cutoff)
    long, _ = forecast.forecast_all(ready, job.keys, job.cutoff, job.n_trees)
    job.written.append(tables.write_forecasts(long, job.keys, prefix=job.prefix))
    flags = job.table("marts", "mart_demand_features").select(*job.keys, "date", "anomaly_flag")
    wide = job.table("marts", "mart_forecast_output").join(flags, [*job.keys, "date"], "left")
    return evaluate.model_summary(forecast.to_long(wide, job.keys, list(fv.MODEL_TITLES)))


def build_recommendations(job: Job) -> None:
    forecasts = job.placed(job.table("marts", "mart_forecast_output"))
    wx, mart = job.table("marts", "mart_weather_daily"), job.table("marts", "mart_demand_features")
    dates = recommend.resolve_dates(job.selection, forecasts, wx, mart, job.keys)
    context = recommend.recommendation_context(forecasts, wx, mart, job.keys, dates)
    prompts, calls = recommend.with_prompt(context), (job.retries, job.wait, job.parallelism)
    if job.answers is None:
        texts = recommend.generate(prompts, job.answer, *calls)
    else:
        texts = recommend.generate_stored(prompts, job.answer, job.answers, *calls)
    texts = texts.select(*job.keys, "date", "prompt", "recommendation")
    # Sorting runs after the calls, so it cannot repeat one.
    job.save(texts, "marts", "mart_ai_recommendations", job.keys)


PREPARE = (ingest_weather, load_weather, ingest_sales, load_sales, build_silver, build_gold)


def run_pipeline(job: Job, models: bool = True) -> list[dict]:
    """Runs everything; returns name, rows and date range of each table written.

    Without `models` it ends with the gold tables. Recommendations are written when an `answer` function is given.
    """
    for stage in (*PREPARE, build_forecasts) if models else PREPARE:
        stage(job)
    if models and job.answer is not None:
        build_recommendations(job)
    return job.written
