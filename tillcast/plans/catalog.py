"""Registered queries: each reads the star-schema tables through the adapters and runs one operator
or one table of the pipeline on all of their rows."""

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast import schemas
from tillcast.functions.expressions import feature_group
from tillcast.operators import (
    boosted, demand, evaluate, features, forecast, quality, recommend, reshape, seasonal, staging, weather,
)
from tillcast.plans import adapters as ad
from tillcast.plans import pipeline
from tillcast.plans.adapters import CITY, CUTOFF, KEYS, ON
from tillcast.session import cut_lineage, shared_folder
from tillcast.sources import files, tables

# Oracle-checkable stand-ins for model columns: the constant forecast and the value a week ago.
STAND_INS = ["naive_prediction", "lag7_prediction"]
STAND_IN_TITLES = {"naive_prediction": "Naive Baseline", "lag7_prediction": "Same Day Last Week"}
DATE_LIST = "2001-02-15, 2001-03-04,2001-04-06, 2001-13-01, soon"

# Sums over nodes are checked on the first trees; every tree's count alike.
IDENTITY_TREES = 25

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on row order in the last digits."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- shared inputs ---------------------------------------------------------

def _stg_weather(spark, sf, days=None):
    return staging.stg_weather(ad.weather_daily(spark, sf, days))


def _stg_sales(spark, sf, days=None):
    return staging.stg_sales(ad.sales_daily(spark, sf, days), KEYS)


def _weather(spark, sf, days=None):
    return weather.mart_weather_daily(_stg_weather(spark, sf, days))


def _demand(spark, sf, days=None):
    # Sales and weather read the same orders: their sums per place and day are taken once.
    days = cut_lineage(ad.place_days(spark, sf)) if days is None else days
    return demand.mart_demand_features(_stg_sales(spark, sf, days), _weather(spark, sf, days), KEYS, ON)


def _gold(spark, sf, days=None):
    """Both gold tables evaluated once, for queries with several branches over them: the joins of
    lines, orders and customers are the large part, the tables have a row per place and day."""
    days = cut_lineage(ad.place_days(spark, sf)) if days is None else days
    wx = cut_lineage(_weather(spark, sf, days))
    return wx, cut_lineage(demand.mart_demand_features(_stg_sales(spark, sf, days), wx, KEYS, ON))


def _features(spark, sf):
    return features.model_features(_demand(spark, sf), KEYS, CUTOFF)


def _forecasts(demand_mart):
    """Test days with the two stand-in forecasts, one column each."""
    rows = features.drop_warmup(demand_mart).withColumns({
        "naive_prediction": forecast.last_train_value(KEYS, CUTOFF).cast("double"),
        "lag7_prediction": F.col("sales_lag_7").cast("double"),
    })
    return rows.filter(~features.is_train(CUTOFF)).select(
        *KEYS, "date", F.col("units_sold").alias("actual_units_sold"), "anomaly_flag", *STAND_INS
    )


def _forecast_table(demand_mart):
    return _forecasts(demand_mart).drop("anomaly_flag")


def _long(spark, sf):
    return forecast.to_long(_forecasts(_demand(spark, sf)), KEYS, STAND_INS)


def _resolved(wx, mart, selection):
    return recommend.resolve_dates(selection, _forecast_table(mart), wx, mart, KEYS, CITY)


def _context(wx, mart, dates=None):
    return recommend.recommendation_context(_forecast_table(mart), wx, mart, KEYS, dates, "lag7_prediction", CITY)


def _with_prompt(context):
    """The star schema has no departments; a region is store and city at once."""
    return recommend.with_prompt(context, department=F.lit("RETAIL"), city=CITY)


# --- sales and calendar ----------------------------------------------------

@query
def sales_melt(spark, sf):
    return reshape.melt_days(ad.sales_wide(spark, sf))


@query
def calendar_days(spark, sf):
    return reshape.calendar_with_d(ad.calendar(spark, sf))


@query
def sales_calendar_join(spark, sf):
    long = reshape.melt_days(ad.sales_wide(spark, sf))
    return reshape.attach_calendar(long, reshape.calendar_with_d(ad.calendar(spark, sf)))


@query
def sales_daily_totals(spark, sf):
    return reshape.daily_sales(ad.sales_wide(spark, sf), ad.calendar(spark, sf))


@query
def sales_series_daily(spark, sf):
    one = reshape.filter_series(ad.sales_wide(spark, sf), "ASIA", "R")
    return reshape.daily_sales(one, ad.calendar(spark, sf), [])


def _csv(df, folder, key):
    """`df` as several CSV files with headers, as many as the session runs tasks at a time. Rows are dealt by `key`: dealt
    in turn they would be sorted first, and a task would hold its share of the matrix in memory."""
    files = max(3, df.sparkSession.sparkContext.defaultParallelism)
    df.repartition(files, key).write.option("header", True).csv(folder)
    return folder


@query
def csv_round_trip(spark, sf):
    """The matrix and the calendar written as CSV files, read back by their headers, melted and joined."""
    folder = shared_folder(spark, "csv")
    wide = files.read_sales_wide(spark, _csv(ad.sales_wide(spark, sf), f"{folder}/sales", "item_id"))
    calendar = files.read_calendar(spark, _csv(ad.calendar(spark, sf), f"{folder}/calendar", "date"))
    return reshape.attach_calendar(reshape.melt_days(wide), reshape.calendar_with_d(calendar))


# --- bronze ----------------------------------------------------------------

@query
def weather_json_rows(spark, sf):
    payloads = ad.weather_payloads(spark, sf)
    return reshape.weather_rows(
        payloads.select("city", F.from_json("body", schemas.WEATHER_PAYLOAD).alias("p")).select("city", "p.daily")
    )


@query
def bronze_weather(spark, sf):
    rows = quality.conform(ad.weather_daily(spark, sf), schemas.BRONZE_WEATHER)
    # Raw tables hold doubles: single precision widened again.
    return quality.conform(rows, schemas.RAW_WEATHER)


@query
def bronze_sales(spark, sf):
    return quality.conform(ad.sales_daily(spark, sf), schemas.keyed(schemas.BRONZE_SALES, KEYS))


REPLACED_CITY, REPLACED_FROM = "ASIA", "1998-01-01"


@query
def bronze_round_trip(spark, sf):
    """Weather of all cities written, one city brought again with fewer days, everything read back."""
    path = shared_folder(spark, "bronze")
    rows = quality.conform(ad.weather_daily(spark, sf), schemas.BRONZE_WEATHER)
    tables.write_bronze(rows, path, ["city"])
    tables.write_bronze(rows.filter((F.col("city") == REPLACED_CITY) & (F.col("date") >= REPLACED_FROM)), path, ["city"])
    return files.read_bronze(spark, path, schemas.RAW_WEATHER)


@query
def pipeline_tables(spark, sf):
    """The batch job over exported files, without models: what it wrote. Its databases go again."""
    folder = shared_folder(spark, "job")
    _csv(ad.sales_wide(spark, sf), f"{folder}/sales", "item_id")
    _csv(ad.calendar(spark, sf), f"{folder}/calendar", "date")
    # One document a file, as the service returns them.
    payloads = ad.weather_payloads(spark, sf).select("city", F.col("body").alias("value"))
    payloads.write.option("maxRecordsPerFile", 1).partitionBy("city").text(f"{folder}/landing")
    places = ad.load(spark, sf, "region").select(F.col("r_name").alias("store_id"), F.col("r_name").alias("city"))
    prefix = f"job_{folder.rsplit('-', 1)[1]}_"
    job = pipeline.Job(
        spark, f"{folder}/lake", f"{folder}/sales", f"{folder}/calendar", f"{folder}/landing", store_city=places,
        cutoff=CUTOFF, prefix=prefix,
    )
    try:
        facts = pipeline.run_pipeline(job, models=False)
    finally:
        for name in tables.LAYERS.values():
            spark.sql(f"DROP DATABASE IF EXISTS {prefix}{name} CASCADE")
    rows = [(f["table"].removeprefix(prefix), f["rows"], str(f["min_date"]), str(f["max_date"])) for f in facts]
    return spark.createDataFrame(rows, "table_name string, rows long, first_day string, last_day string")


@query
def required_nulls(spark, sf):
    return quality.null_counts(ad.raw_weather(spark, sf), schemas.required(schemas.BRONZE_WEATHER))


# --- silver ----------------------------------------------------------------

@query
def stg_weather(spark, sf):
    return staging.stg_weather(ad.raw_weather(spark, sf))


@query
def stg_sales(spark, sf):
    return staging.stg_sales(ad.raw_sales(spark, sf), KEYS)


# --- gold: weather ---------------------------------------------------------

@query
def weather_rolling(spark, sf):
    return weather.with_history(_stg_weather(spark, sf)).select("city", "date", "rolling_avg_temp_7d")


@query
def weather_lags(spark, sf):
    return weather.with_history(_stg_weather(spark, sf)).select("city", "date", "temp_lag_3", "temp_lag_7")


@query
def weather_monthly_stats(spark, sf):
    return _round(weather.monthly_stats(_stg_weather(spark, sf)), "monthly_avg_temp", "monthly_stddev_temp")


@query
def weather_anomaly(spark, sf):
    return _stg_weather(spark, sf).select("city", "date", weather.anomaly_flag().alias("anomaly_flag"))


@query
def weather_labels(spark, sf):
    return weather.with_labels(_stg_weather(spark, sf)).select(
        "city", "date", "temperature_range", "season", "is_extreme_heat", "is_heavy_rain", "weather_description"
    )


@query
def mart_weather_daily(spark, sf):
    return _weather(spark, sf)


# --- gold: demand ----------------------------------------------------------

@query
def demand_join(spark, sf):
    days = cut_lineage(ad.place_days(spark, sf))
    return demand.join_weather(_stg_sales(spark, sf, days), _weather(spark, sf, days), KEYS, ON)


@query
def sales_lags(spark, sf):
    return demand.with_sales_lags(_stg_sales(spark, sf), KEYS).select(*KEYS, "date", "sales_lag_7", "sales_lag_14")


@query
def sales_rolling(spark, sf):
    return demand.with_sales_rolling(_stg_sales(spark, sf), KEYS).select(
        *KEYS, "date", "sales_rolling_avg_7d", "sales_rolling_avg_14d"
    )


@query
def sales_rolling_known(spark, sf):
    """Means that end the day before, the variant a real forecast could use."""
    return demand.with_sales_rolling(_stg_sales(spark, sf), KEYS, include_current=False).select(
        *KEYS, "date", "sales_rolling_avg_7d", "sales_rolling_avg_14d"
    )


@query
def sales_densified(spark, sf):
    """Means over seven days instead of seven rows: days that the raw rows lack are filled in first."""
    dense = demand.densify_dates(staging.stg_sales(ad.raw_sales(spark, sf), KEYS), KEYS)
    return demand.with_sales_rolling(dense, KEYS).select(*KEYS, "date", "units_sold", "sales_rolling_avg_7d")


@query
def mart_demand_features(spark, sf):
    return _demand(spark, sf)


# --- features --------------------------------------------------------------

@query
def features_lead(spark, sf):
    return _round(features.prepare_features(_demand(spark, sf), KEYS), "temp_change_3d").select(
        *KEYS, "date", "tomorrow_temp", "tomorrow_precipitation", "tomorrow_extreme_heat", "tomorrow_heavy_rain",
        "temp_change_3d",
    )


def _shocks(spark, sf, use_weather_code):
    prepared = features.prepare_features(_demand(spark, sf), KEYS)
    shocks = features.add_weather_shocks(prepared, KEYS, CUTOFF, use_weather_code)
    return _round(shocks, "temp_anomaly_from_monthly").select(
        *KEYS, "date", "month", "temp_anomaly_from_monthly", "unseasonable_heat", "shopping_deterrence"
    )


@query
def features_shock(spark, sf):
    return _shocks(spark, sf, True)


@query
def features_shock_chart(spark, sf):
    return _shocks(spark, sf, False)


@query
def monthly_baseline(spark, sf):
    prepared = features.drop_warmup(_demand(spark, sf))
    return _round(features.monthly_baseline(prepared, KEYS, CUTOFF), "monthly_mean_temp")


@query
def train_medians(spark, sf):
    shocks = features.model_features(_demand(spark, sf), KEYS, CUTOFF, impute=False)
    return _round(features.train_medians(shocks, KEYS, cutoff=CUTOFF), *fv.WEATHER_REGRESSORS)


@query
def features_impute(spark, sf):
    return _round(_features(spark, sf), *fv.WEATHER_REGRESSORS).select(*KEYS, "date", *fv.WEATHER_REGRESSORS)


@query
def features_fill_zero(spark, sf):
    shocks = features.model_features(_demand(spark, sf), KEYS, CUTOFF, impute=False)
    filled = features.fill_zero(shocks, fv.WEATHER_FEATURES)
    return _round(filled, "temp_anomaly_from_monthly", "temp_change_3d").select(*KEYS, "date", *fv.WEATHER_FEATURES)


@query
def split_counts(spark, sf):
    return features.split_counts(features.drop_warmup(_demand(spark, sf)), CUTOFF)


@query
def split_series(spark, sf):
    return features.split_series(features.drop_warmup(_demand(spark, sf)), KEYS, CUTOFF)


# --- forecasts and errors --------------------------------------------------

@query
def forecast_naive(spark, sf):
    return forecast.forecast_naive(features.drop_warmup(_demand(spark, sf)), KEYS, CUTOFF)


@query
def forecast_output(spark, sf):
    prepared = cut_lineage(features.drop_warmup(_demand(spark, sf)))
    week_ago = prepared.select(*KEYS, "date", F.col("sales_lag_7").cast("double").alias("prediction"))
    predictions = [forecast.forecast_naive(prepared, KEYS, CUTOFF), week_ago]
    long = forecast.collect_predictions(prepared, dict(zip(STAND_INS, predictions)), KEYS, CUTOFF)
    return tables.forecast_output(long, KEYS, STAND_INS)


@query
def forecast_metrics(spark, sf):
    return _round(evaluate.forecast_metrics(_long(spark, sf)), "rmse", "mae", "mape", "anomaly_mape")


@query
def forecast_metrics_by_store(spark, sf):
    return _round(evaluate.forecast_metrics(_long(spark, sf), KEYS), "rmse", "mae", "mape", "anomaly_mape")


@query
def model_summary(spark, sf):
    return _round(evaluate.model_summary(_long(spark, sf), STAND_IN_TITLES), "rmse", "mae", "mape")


@query
def residuals(spark, sf):
    return evaluate.residuals(_long(spark, sf), KEYS)


@query
def residual_stats(spark, sf):
    return _round(evaluate.residual_stats(_long(spark, sf)), "mean_residual")


@query
def residual_histogram(spark, sf):
    return evaluate.residual_histogram(_long(spark, sf))


@query
def scatter_bounds(spark, sf):
    return _round(evaluate.scatter_bounds(_long(spark, sf)), "mape")


@query
def actual_vs_predicted(spark, sf):
    return evaluate.actual_vs_predicted(_long(spark, sf), KEYS)


def _comparison(spark, sf):
    wx, mart = _gold(spark, sf)
    return evaluate.forecast_comparison(_forecast_table(mart), wx, KEYS, STAND_INS, CITY)


@query
def forecast_comparison(spark, sf):
    return _comparison(spark, sf)


@query
def anomaly_days(spark, sf):
    return evaluate.anomaly_days(_comparison(spark, sf)).select(*KEYS, "date", "actual_units_sold", "label")


@query
def worst_days(spark, sf):
    wx, mart = _gold(spark, sf)
    return evaluate.worst_days(_forecast_table(mart), wx, KEYS, "lag7_prediction", city=CITY)


# --- what the models read --------------------------------------------------

@query
def seasonal_design(spark, sf):
    """The seasonal model's columns: time, trend changes, weekly and yearly waves, standardised regressors."""
    design = seasonal.seasonal_design(_features(spark, sf), KEYS, CUTOFF, fv.WEATHER_REGRESSORS)
    named = {
        "trend": ("trend_terms", seasonal.CHANGEPOINTS + 2), "weekly": ("weekly_terms", 2 * seasonal.WEEKLY[1]),
        "yearly": ("yearly_terms", 2 * seasonal.YEARLY[1]), "regressor": ("regressor_terms", len(fv.WEATHER_REGRESSORS)),
    }
    columns = [F.round(F.col(c)[i], 6).alias(f"{name}_{i}") for name, (c, n) in named.items() for i in range(n)]
    return design.select(*KEYS, "date", "y", "train", *columns)


@query
def boosted_matrix(spark, sf):
    """The boosted models' columns after filling: label, split, the 19 features, of which the first 7 are
    those of the model without weather."""
    frame = boosted.feature_frame(_features(spark, sf), KEYS, fv.WEATHER_FEATURES, CUTOFF)
    values = vector_to_array("features")
    columns = [F.round(values[i], 6).alias(f) for i, f in enumerate(fv.WEATHER_FEATURES)]
    return frame.select(*KEYS, "date", "label", "train", *columns)


@query
def feature_profile(spark, sf):
    """Per feature over all training rows: chart group, gaps that filling closes, mean after filling."""
    rows = features.model_features(_demand(spark, sf), KEYS, CUTOFF, impute=False)
    train = rows.filter(features.is_train(CUTOFF)).select(*[F.col(f).cast("double").alias(f) for f in fv.WEATHER_FEATURES])
    stats = train.agg(
        *[F.count_if(F.col(f).isNull()).alias(f"{f}_gaps") for f in fv.WEATHER_FEATURES],
        *[F.avg(F.coalesce(F.col(f), F.lit(0.0))).alias(f"{f}_mean") for f in fv.WEATHER_FEATURES],
    )
    lines = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}_gaps").alias("gaps"), F.round(f"{f}_mean", 6).alias("mean"))
        for f in fv.WEATHER_FEATURES
    ])
    return stats.select(F.explode(lines).alias("l")).select("l.*").withColumn("feature_group", feature_group("feature"))


@query
def chart_features(spark, sf):
    """What the chart run's boosted model reads: zero fill, and a deterrence score without the weather code."""
    rows = features.model_features(_demand(spark, sf), KEYS, CUTOFF, impute=False, use_weather_code=False)
    filled = features.fill_zero(rows, fv.WEATHER_FEATURES)
    return _round(filled, "temp_anomaly_from_monthly", "temp_change_3d").select(*KEYS, "date", *fv.WEATHER_FEATURES)


# --- trained models --------------------------------------------------------

@query
def forecast_seasonal(spark, sf):
    return seasonal.forecast_seasonal(_features(spark, sf), KEYS, CUTOFF)


@query
def forecast_seasonal_weather(spark, sf):
    return seasonal.forecast_seasonal(_features(spark, sf), KEYS, CUTOFF, fv.WEATHER_REGRESSORS)


@query
def decomposition(spark, sf):
    return seasonal.decompose(_features(spark, sf), KEYS, CUTOFF)


def _fitted(spark, sf):
    """Features, and the stored coefficients of the seasonal model with weather."""
    prepared = cut_lineage(_features(spark, sf))
    return prepared, cut_lineage(seasonal.coefficients(prepared, KEYS, CUTOFF, fv.WEATHER_REGRESSORS))


@query
def seasonal_gradient(spark, sf):
    """The gradient of the seasonal fit's objective at its coefficients: 0 where the fit is optimal."""
    prepared, fitted = _fitted(spark, sf)
    design = seasonal.seasonal_design(prepared, KEYS, CUTOFF, fv.WEATHER_REGRESSORS)
    gradient = seasonal.ridge_gradient(design, fitted, KEYS)
    return gradient.withColumn("gradient", F.round(F.abs("gradient"), 6))


@query
def decomposition_identity(spark, sf):
    """How far the components that the fit returns are from those that its stored coefficients give."""
    prepared, fitted = _fitted(spark, sf)
    design = seasonal.seasonal_design(prepared, KEYS, CUTOFF, fv.WEATHER_REGRESSORS)
    again = seasonal.recomposed(design, fitted, KEYS).filter(~F.col("train"))
    parts = seasonal.decompose(prepared, KEYS, CUTOFF, fv.WEATHER_REGRESSORS)
    names = {p: f"{p}_again" for p in seasonal.PARTS}
    both = parts.join(again.withColumnsRenamed(names), [*KEYS, "date"], "full")
    off = {p: F.round(F.abs(F.col(p) - F.col(q)) / (1 + F.abs(F.col(p))), 9) for p, q in names.items()}
    return both.select(*KEYS, "date", *[c.alias(p) for p, c in off.items()])


@query
def importance_identity(spark, sf):
    """The importance of every rank beside what the nodes of the trees themselves add up to."""
    prepared = _features(spark, sf)
    model = boosted.forecast_boosted(prepared, KEYS, fv.WEATHER_FEATURES, CUTOFF, IDENTITY_TREES)[1]
    known = boosted.feature_importance(prepared, model, fv.WEATHER_FEATURES)
    nodes = boosted.importance_from_nodes(boosted.tree_nodes(model, spark), fv.WEATHER_FEATURES)
    both = known.join(nodes.select("feature", F.col("importance").alias("again"), F.col("rank").alias("again_rank")), "feature", "full")
    return both.select(
        "rank", F.round(F.abs(F.col("importance") - F.col("again")), 9).alias("difference"), "again_rank",
        F.round(F.sum("again").over(Window.partitionBy()), 9).alias("total"),
    )


@query
def forecast_gbt(spark, sf):
    return boosted.forecast_boosted(_features(spark, sf), KEYS, fv.BASE_FEATURES, CUTOFF)[0]


@query
def forecast_gbt_weather(spark, sf):
    return boosted.forecast_boosted(_features(spark, sf), KEYS, fv.WEATHER_FEATURES, CUTOFF)[0]


@query
def feature_importance(spark, sf):
    prepared = _features(spark, sf)
    model = boosted.forecast_boosted(prepared, KEYS, fv.WEATHER_FEATURES, CUTOFF)[1]
    return boosted.feature_importance(prepared, model, fv.WEATHER_FEATURES)


@query
def model_comparison(spark, sf):
    long, _ = forecast.forecast_all(_features(spark, sf), KEYS, CUTOFF)
    return evaluate.model_summary(long)


# --- recommendations -------------------------------------------------------

@query
def available_dates(spark, sf):
    return recommend.available_dates(_forecasts(_demand(spark, sf)))


@query
def dates_anomaly(spark, sf):
    return _resolved(*_gold(spark, sf), "Anomaly")


@query
def dates_snap(spark, sf):
    return _resolved(*_gold(spark, sf), " snap ")


@query
def dates_list(spark, sf):
    return _resolved(*_gold(spark, sf), DATE_LIST)


@query
def recommendation_context(spark, sf):
    return _round(_context(*_gold(spark, sf)), "error_pct")


@query
def recommendation_prompt(spark, sf):
    prompts = recommend.headline(_with_prompt(_context(*_gold(spark, sf))))
    return prompts.select(*KEYS, "date", "prompt", "headline")


def stub_answer(prompt: str) -> str:
    """Stands in for a text service: fails on some prompts, measures the others."""
    if "Conditions: Unknown" in prompt:
        raise ValueError("no weather")
    return f"{len(prompt)} characters"


@query
def recommendation_generate(spark, sf):
    wx, mart = _gold(spark, sf)
    prompts = _with_prompt(_context(wx, mart, _resolved(wx, mart, "anomaly")))
    return recommend.generate(prompts, stub_answer, wait=0.0).select(*KEYS, "date", "recommendation")


# --- data quality and table facts ------------------------------------------

@query
def dq_report(spark, sf):
    days = cut_lineage(ad.place_days(spark, sf))
    wx, mart = _gold(spark, sf, days)
    inputs = {
        "stg_weather": staging.stg_weather(ad.raw_weather(spark, sf, days)),
        "stg_sales": staging.stg_sales(ad.raw_sales(spark, sf, days), KEYS),
        "mart_weather_daily": wx,
        "mart_demand_features": mart,
    }
    return quality.run_checks(inputs, quality.standard_tests(KEYS, ["city"]))


@query
def table_stats(spark, sf):
    return tables.table_stats(_weather(spark, sf), city_col="city")


@query
def table_stats_by_city(spark, sf):
    return tables.table_stats(_weather(spark, sf), by=["city"])


@query
def series_head(spark, sf):
    return tables.preview(_stg_sales(spark, sf), ["date", *KEYS])


@query
def series_tail(spark, sf):
    return tables.preview(_stg_sales(spark, sf), ["date", *KEYS], last=True)
