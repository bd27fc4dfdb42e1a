"""Parquet and table writers, table names by layer, and what was written."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillcast.fixed_values import MODEL_TITLES
from tillcast.session import cut_lineage
from tillcast.sources.files import has_files

BUCKET = "bucket"

# Layer -> database.
LAYERS = {
    "weather_raw": "weather_raw",
    "sales_raw": "sales_raw",
    "staging": "weather_staging",
    "marts": "weather_marts",
}


# Folders of a bronze table, however many series it has.
BUCKETS = 64


def write_bronze(df: DataFrame, path: str, by: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Replaces `path`, or with `by` only the rows of the keys that `df` has. Keys are dealt by hash over at most
    `buckets` folders; the folders that `df` touches are read, merged and overwritten, the others stay. A job that fails
    leaves what was there, since everything is evaluated before a folder is replaced."""
    if not by:
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return
    spark = df.sparkSession
    new = cut_lineage(df.withColumn(BUCKET, F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")))
    if has_files(spark, path):
        touched = [row[0] for row in new.select(BUCKET).distinct().collect()]
        old = spark.read.schema(new.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
        new = cut_lineage(old.join(new.select(*by).distinct(), list(by), "left_anti").select(*new.columns).union(new))
    # Files of about the advised size; a folder with many rows gets several.
    new.hint("rebalance", BUCKET).write.mode("overwrite").options(
        compression="snappy", partitionOverwriteMode="dynamic"
    ).partitionBy(BUCKET).parquet(path)


def table_name(layer: str, name: str, prefix: str = "") -> str:
    return f"{prefix}{LAYERS[layer]}.{name}"


def write_table(df: DataFrame, name: str, date_col: str | None = "date") -> dict:
    """Replace a table completely, so running twice equals running once.

    Row count and date range are observed by the write itself; no second scan.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if date_col and date_col in df.columns:
        metrics += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    seen = Observation()
    df.observe(seen, *metrics).write.mode("overwrite").format("parquet").saveAsTable(name)
    return {"table": name, **seen.get}


def materialize(
    df: DataFrame, layer: str, name: str, date_col: str | None = "date", sort_by: Sequence[str] = (), prefix: str = ""
) -> dict:
    """Write a model as a table of its layer's database, whose name may get a prefix.

    A table has no global order. `sort_by` orders the rows within each file, which needs no shuffle and
    gives Parquet narrow value ranges to skip by.
    """
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{LAYERS[layer]}")
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return write_table(df, table_name(layer, name, prefix), date_col)


def table(spark: SparkSession, layer: str, name: str, prefix: str = "") -> DataFrame:
    return spark.table(table_name(layer, name, prefix))


def forecast_output(long: DataFrame, keys: Sequence[str], models: Sequence[str] = tuple(MODEL_TITLES)) -> DataFrame:
    """Long predictions -> one row per series and day with a column per model.

    The model list is given, so the pivot needs no extra pass to discover it.
    """
    wide = (
        long.groupBy(*keys, "date", F.col("actual").alias("actual_units_sold"))
        .pivot("model", list(models))
        .agg(F.max("predicted"))
    )
    return wide.select(*keys, "date", "actual_units_sold", *models)


def write_forecasts(
    long: DataFrame, keys: Sequence[str], models: Sequence[str] = tuple(MODEL_TITLES), prefix: str = ""
) -> dict:
    wide = forecast_output(long, keys, models)
    return materialize(wide, "marts", "mart_forecast_output", sort_by=[*keys, "date"], prefix=prefix)


def table_stats(df: DataFrame, by: Sequence[str] = (), city_col: str | None = None, date_col: str = "date") -> DataFrame:
    """Rows and date range of a table, whole or per `by`, with how many cities and which."""
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
    ]
    if city_col:
        metrics += [
            F.count_distinct(city_col).alias("cities"),
            F.concat_ws(", ", F.array_sort(F.collect_set(city_col))).alias("city_names"),
        ]
    return df.groupBy(*by).agg(*metrics)


def preview(df: DataFrame, by: Sequence[str], n: int = 5, last: bool = False) -> DataFrame:
    """First or last `n` rows in the order of `by`, without sorting the table."""
    order = [F.col(c).desc() if last else F.col(c).asc() for c in by]
    return df.orderBy(*order).limit(n)
