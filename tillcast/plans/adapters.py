"""Sales, weather and calendar inputs derived from the star-schema tables.

A region plays the store and its city. Units sold come from line items; the weather is a deterministic
function of the day's orders, so that both engines of the check derive the same rows.

Joins carry no broadcast hints: customers and orders grow with the data, and for the small dimensions
Spark decides by measured size. Line items are summed per order on the key that they meet orders with, and
orders per customer and day before they meet customers, so a customer brings at most a row per day.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.reshape import DAY_PREFIX
from tillcast.session import shared_folder

KEYS = ["store_id"]
# The store's city carries the store's name.
ON = (("store_id", "city"), ("date", "date"))
CITY = "store_id"
CUTOFF = "2001-01-01"

# Weather codes by remainder; 99 has no label.
CODES = [0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 80, 81, 82, 95, 99]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    places = nation.join(region, F.expr("n_regionkey = r_regionkey"))
    return customer.join(places, F.expr("c_nationkey = n_nationkey")).select("c_custkey", "r_name")


# Fixed values of the derived inputs, as SQL shared by the readers below.
DATE = "cast(o_orderdate as date)"
# The remainder keeps sums of the seed far from overflow at any size.
SEED = "(o_orderkey * 31 + o_custkey) % 1000003"
EVENT = "o_orderpriority = '1-URGENT' and o_orderkey % 7 = 0"
SNAP = "case when day({0}) <= 10 then 1 else 0 end"
DAY_CODE = "dayofweek({0}) % 7 + 1"


def place_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and day the units sold, whether it had an event, and the weather's seed `k`: what sales and
    weather take from the orders, in one pass over them."""
    per_order = (
        load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    )
    orders = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", f"{DATE} as date", f"case when {EVENT} then 1 else 0 end as event", f"{SEED} as part"
    )
    sums = [
        F.sum("quantity").alias("quantity"), F.count("quantity").alias("sold"),
        F.max(F.when(F.col("quantity").isNotNull(), F.col("event"))).alias("event"), F.sum("part").alias("k"),
    ]
    per_customer = orders.join(per_order, F.expr("l_orderkey = o_orderkey"), "left").groupBy("o_custkey", "date").agg(*sums)
    placed = per_customer.join(customer_region(spark, sf_dir), F.expr("o_custkey = c_custkey"))
    return placed.groupBy("r_name", "date").agg(
        F.sum("quantity").alias("quantity"), F.sum("sold").alias("sold"), F.max("event").alias("event"), F.sum("k").alias("k")
    )


def sales_daily(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    days = place_days(spark, sf_dir) if days is None else days
    return days.filter("sold > 0").selectExpr(
        "r_name as store_id", "date", "cast(quantity as bigint) as units_sold", f"{SNAP.format('date')} as snap_ca",
        "event as is_event", f"{DAY_CODE.format('date')} as day_of_week",
    )


def _weather_seed(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    """A number `k` per city and day. On its own it needs no line items."""
    if days is not None:
        return days.selectExpr("r_name as city", "date", "k")
    orders = load(spark, sf_dir, "orders").selectExpr("o_custkey", f"{DATE} as date", f"{SEED} as part")
    per_customer = orders.groupBy("o_custkey", "date").agg(F.sum("part").alias("part"))
    placed = per_customer.join(customer_region(spark, sf_dir), F.expr("o_custkey = c_custkey"))
    return placed.groupBy(F.col("r_name").alias("city"), "date").agg(F.sum("part").alias("k"))


def _weather_columns(seed: DataFrame) -> DataFrame:
    warm = "320 - abs(month(date) - 7) * 25 + (k % 81) - 40 + case when k % 61 = 0 then 130 else 0 end"
    codes = ", ".join(f"{i}, {code}" for i, code in enumerate(CODES))
    return seed.selectExpr("*", f"cast({warm} as bigint) as tmax").selectExpr(
        "k", "city", "date",
        "tmax / 10.0D as temperature_max",
        "(tmax - 50 - k % 60) / 10.0D as temperature_min",
        "case when k % 5 = 0 then (k % 250) / 10.0D when k % 97 <> 0 then 0.0D end as precipitation_sum",
        "(50 + k % 200) / 10.0D as wind_speed_max",
        f"map({codes})[cast(k % 20 as int)] as weather_code",
    )


def weather_daily(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    return _weather_columns(_weather_seed(spark, sf_dir, days)).drop("k")


def raw_weather(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    """Date strings with unreadable, partial and missing ones; some missing temperatures."""
    return _weather_columns(_weather_seed(spark, sf_dir, days)).selectExpr(
        "case when k % 101 = 0 then 'bad' when k % 103 = 0 then '2016' when k % 107 = 0 then null "
        "else date_format(date, 'yyyy-MM-dd') end as date",
        "city", "temperature_max", "case when k % 109 <> 0 then temperature_min end as temperature_min",
        "precipitation_sum", "wind_speed_max", "weather_code",
    )


def raw_sales(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    return sales_daily(spark, sf_dir, days).selectExpr(
        "store_id",
        "case when units_sold % 101 = 0 then 'bad' when units_sold % 103 = 0 then null "
        "else date_format(date, 'yyyy-MM-dd') end as date",
        "case when units_sold % 97 <> 0 then units_sold end as units_sold",
        "snap_ca", "is_event", "day_of_week",
    )


# Days of the orders; the matrix has one column more, without a calendar row.
FIRST_DAY, LAST_DAY, MATRIX_DAYS = "1995-01-01", "2001-08-01", 2405


def sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item x day matrix, written once and read back by its schema. The pivot has thousands of columns: planned
    together with what reads it, the code of one stage would outgrow what the JVM compiles."""
    matrix, folder = _pivoted(spark, sf_dir), shared_folder(spark, "sales-matrix")
    matrix.write.parquet(folder)
    return spark.read.schema(matrix.schema).parquet(folder)


# Line items, or sums of them, that a task of the matrix step holds. Their number sets the partitions: left to the session, a
# partition grows with the tables up to the advisory size, and beyond where the number of partitions is fixed.
TASK_ROWS = 500_000


def _pivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item is a supplier's, a column a day from FIRST_DAY on. Quantities are summed before and after the join.

    `pivot` would hold a buffer of all days for each item of a task. Here an item is the list of the days it sold on,
    up to the moment its row is written; sums and lists spill when memory is short.

    Line items are dealt before they are summed: summed as they are read, a task would hold the sums of its whole file
    split. Orders meet customers first, by themselves, so that a customer with many orders does not bring their items along.
    """
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    tasks = max(spark.sparkContext.defaultParallelism, -(-lines.count() // TASK_ROWS))
    per_order = lines.repartition(tasks, "l_orderkey", "l_suppkey").groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("units")
    )
    orders = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", f"datediff({DATE}, date'{FIRST_DAY}') + 1 as day"
    )
    placed = orders.join(customer_region(spark, sf_dir), F.expr("o_custkey = c_custkey")).select("o_orderkey", "r_name", "day")
    sold = per_order.repartition(tasks, "l_orderkey").join(
        placed.repartition(tasks, "o_orderkey"), F.expr("l_orderkey = o_orderkey")
    )
    per_day = sold.repartition(tasks, "l_suppkey", "r_name", "day").groupBy("l_suppkey", "r_name", "day").agg(
        F.expr("cast(sum(units) as int) as units")
    )
    # A list leaves NULLs out: an item without a day of the matrix keeps its row.
    sold_on = F.expr(f"case when day between 1 and {MATRIX_DAYS} then struct(day, units) end")
    items = per_day.repartition(tasks, "l_suppkey", "r_name").groupBy("l_suppkey", "r_name").agg(
        F.array_sort(F.collect_list(sold_on)).alias("sold")
    )
    # Each sold day after the NULLs of the days since the one before; what follows the last is out of the array.
    gap = "array_repeat(cast(null as int), x.day - 1 - case when i = 0 then 0 else sold[i - 1].day end)"
    matrix = items.withColumn("cells", F.expr(f"flatten(transform(sold, (x, i) -> concat({gap}, array(x.units))))"))
    ids = ["concat('item_', l_suppkey) as item_id", "r_name as store_id", f"{CATEGORY} as cat_id"]
    extra = f"cast(null as int) as {DAY_PREFIX}{MATRIX_DAYS + 1}"
    return matrix.selectExpr(*ids, *[f"get(cells, {n}) as {DAY_PREFIX}{n + 1}" for n in range(MATRIX_DAYS)], extra)


CATEGORY = "case l_suppkey % 3 when 0 then 'A' when 1 then 'N' else 'R' end"


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the matrix but its last column, with an event on days that had an urgent order with such a key. Written
    once and read back: planned with the orders behind it, its size is taken for theirs, and joins would shuffle
    every cell of the matrix to meet some thousand days."""
    rows, folder = _calendar_days(spark, sf_dir), shared_folder(spark, "calendar")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.sql(f"select explode(sequence(date'{FIRST_DAY}', date'{LAST_DAY}', interval 1 day)) as day")
    events = load(spark, sf_dir, "orders").filter(EVENT).groupBy(F.expr(f"{DATE} as event_day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return days.join(events, F.expr("day = event_day"), "left").selectExpr(
        "date_format(day, 'yyyy-MM-dd') as date",
        f"{DAY_CODE.format('day')} as wday",
        "case when orders is not null then 'Event' end as event_name_1",
        f"{SNAP.format('day')} as snap_CA",
    )


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped JSON text per city and year: parallel arrays of at most 366 days."""
    day = F.expr(
        "struct(date_format(date, 'yyyy-MM-dd') as time, temperature_max as temperature_2m_max, "
        "temperature_min as temperature_2m_min, precipitation_sum, wind_speed_max as wind_speed_10m_max, "
        "weather_code)"
    )
    names = [
        "time", "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "wind_speed_10m_max",
        "weather_code",
    ]
    per_year = (
        weather_daily(spark, sf_dir)
        .groupBy("city", F.year("date").alias("year"))
        .agg(F.array_sort(F.collect_list(day)).alias("days"))
    )
    daily = F.struct(*[F.col(f"days.{n}").alias(n) for n in names]).alias("daily")
    return per_year.select("city", F.to_json(F.struct(daily), {"ignoreNullFields": "false"}).alias("body"))
