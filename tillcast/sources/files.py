"""File readers. Every reader applies a declared schema; nothing is inferred from data."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast import schemas
from tillcast.functions.expressions import null_if_na_token
from tillcast.operators.reshape import DAY_PREFIX, weather_rows


def read_sales_wide(spark: SparkSession, path: str) -> DataFrame:
    """Item rows with one column per day. Types come from the header: `d_*` integer, rest string.

    FAILFAST, because the permissive default would turn a broken count into a silent NULL, and every file's
    header is compared, because columns in another order would silently change places.
    """
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([
        T.StructField(name, T.IntegerType() if name.startswith(DAY_PREFIX) else T.StringType())
        for name in header
    ])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("maxColumns", max(20480, 2 * len(header)))
        .csv(path)
    )


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar rows; any spelling of "no value" in the event name becomes NULL."""
    header = spark.read.option("header", True).csv(path).columns
    declared = {f.name: f.dataType for f in schemas.CALENDAR.fields}
    schema = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in header])
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option(
        "enforceSchema", False
    ).csv(path)
    return rows.withColumn("event_name_1", null_if_na_token("event_name_1")).select(
        *[f.name for f in schemas.CALENDAR.fields]
    )


def read_weather_json(spark: SparkSession, path: str, city: str | None = None) -> DataFrame:
    """One row per city and day out of landed API payloads, one JSON document per file.

    The payload does not name its city. It is given for a single one; for many, the landing folder is
    laid out as `city=<name>/` and all of them are read by one job.
    """
    schema = schemas.WEATHER_PAYLOAD
    if city is None:
        schema = T.StructType(schema.fields + [T.StructField("city", T.StringType())])
    payloads = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return weather_rows(payloads if city is None else payloads.withColumn("city", F.lit(city)))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds a table's files below `path`."""
    try:
        return bool(spark.read.format("binaryFile").load(path).select("path").head(1))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under the declared schema; float32 files widen to a double schema while reading."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
