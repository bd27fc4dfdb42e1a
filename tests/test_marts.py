from datetime import date

import pytest
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.operators import demand, features, staging, weather

WEATHER = (
    "date date, city string, temperature_max double, temperature_min double, precipitation_sum double, "
    "wind_speed_max double, weather_code bigint"
)
SALES = "store_id string, city string, date date, units_sold bigint, snap_ca bigint, is_event bigint, day_of_week bigint"
KEYS = ["store_id"]


def column(df, order, name):
    return [r[name] for r in df.orderBy(*order).collect()]


def test_staging_filters_raw_columns(spark):
    raw = spark.createDataFrame(
        [
            ("2016-01-01", "LA", 18.25, 9.99, None, None, None),
            ("bad", "LA", 1.0, 1.0, 1.0, 1.0, 99),
            ("2016", "LA", 1.0, 1.0, 1.0, 1.0, 99),
            (None, "LA", 1.0, 1.0, 1.0, 1.0, 99),
            ("2016-01-02", "LA", None, 1.0, 1.0, 1.0, 99),
        ],
        "date string, city string, temperature_max float, temperature_min float, precipitation_sum float, "
        "wind_speed_max float, weather_code int",
    )
    out = staging.stg_weather(raw)
    assert out.dtypes == [tuple(f.split(" ")) for f in WEATHER.split(", ")]
    rows = out.orderBy(F.col("date").desc_nulls_last()).collect()
    assert [r.date for r in rows] == [date(2016, 1, 1), None, None]
    assert (rows[0].temperature_max, rows[0].temperature_min) == (18.3, 10.0)


def test_staged_sales(spark):
    raw = spark.createDataFrame(
        [("s", "2016-01-01", 5, 1, 0, 7), ("s", "oops", 5, 1, 0, 7), ("s", "2016-01-02", None, 1, 0, 7)],
        "store_id string, date string, units_sold bigint, snap_ca bigint, is_event bigint, day_of_week bigint",
    )
    assert sorted(str(r.date) for r in staging.stg_sales(raw, KEYS).collect()) == ["2016-01-01", "None"]


@pytest.fixture(scope="module")
def ten_days(spark, days):
    """Nine days at 20 and one at 40 in one month, per city; a second city must not mix in."""
    rows = []
    for city, shift in (("LA", 0.0), ("NY", 100.0)):
        for i, d in enumerate(days(10)):
            rows.append((d, city, (40.0 if i == 9 else 20.0) + shift, 5.0, None, 1.0, 99 if i else None))
    # A month with one row: no deviation, no anomaly.
    rows.append((date(2016, 2, 1), "LA", 99.0, 5.0, 11.0, 1.0, 0))
    return spark.createDataFrame(rows, WEATHER)


def test_weather_mart(ten_days):
    mart = weather.mart_weather_daily(ten_days)
    assert mart.columns == schemas.WEATHER_MART_COLUMNS
    la = mart.filter("city = 'LA'")
    assert column(la, ["date"], "anomaly_flag") == [0] * 9 + [1, 0]
    assert column(la, ["date"], "temp_lag_3")[:4] == [None, None, None, 20.0]
    assert column(la, ["date"], "temp_lag_7")[7] == 20.0
    assert column(la, ["date"], "rolling_avg_temp_7d")[9] == 22.9
    assert column(la, ["date"], "temperature_range")[0] == 15.0
    assert column(la, ["date"], "weather_description")[:2] == ["Unknown", "Unknown"]
    assert column(la, ["date"], "is_heavy_rain") == [0] * 10 + [1]
    stats = weather.monthly_stats(ten_days).filter("city = 'LA' and month = 1").first()
    assert stats.monthly_avg_temp == pytest.approx(22.0)
    assert stats.monthly_stddev_temp == pytest.approx(40**0.5)
    ny = mart.filter("city = 'NY'")
    assert column(ny, ["date"], "rolling_avg_temp_7d")[0] == 120.0


def test_weather_mart_uses_one_shuffle_of_its_own(ten_days):
    plan = weather.mart_weather_daily(ten_days)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.fixture(scope="module")
def sixteen(spark, days):
    rows = []
    for store, factor in (("s1", 10), ("s2", 1000)):
        rows += [(store, "LA", d, factor * (i + 1), 0, 0, 1) for i, d in enumerate(days(16))]
    return spark.createDataFrame(rows, SALES)


def test_demand_mart(sixteen, ten_days):
    mart = demand.mart_demand_features(sixteen, weather.mart_weather_daily(ten_days), KEYS)
    assert mart.count() == 32
    assert mart.columns == [
        "store_id", *schemas.SALES_COLUMNS, *schemas.DEMAND_WEATHER_COLUMNS,
        "sales_lag_7", "sales_lag_14", "sales_rolling_avg_7d", "sales_rolling_avg_14d",
    ]
    one = mart.filter("store_id = 's1'")
    assert column(one, ["date"], "sales_lag_7")[7] == 10
    assert column(one, ["date"], "sales_lag_14")[13:] == [None, 10, 20]
    assert column(one, ["date"], "sales_rolling_avg_7d")[0] == 10.0
    assert column(one, ["date"], "sales_rolling_avg_7d")[7] == 50.0
    assert column(one, ["date"], "sales_rolling_avg_14d")[13] == 75.0
    # Days 11 to 16 have no weather and stay.
    assert column(one, ["date"], "temperature_max")[9:] == [40.0] + [None] * 6
    assert features.drop_warmup(one).count() == 2


def test_rolling_without_the_day_itself(sixteen):
    out = demand.with_sales_rolling(sixteen.filter("store_id = 's1'"), KEYS, include_current=False)
    assert column(out, ["date"], "sales_rolling_avg_7d")[:2] == [None, 10.0]
    assert column(out, ["date"], "sales_rolling_avg_7d")[7] == 40.0


def test_lags_count_rows_not_days(sixteen):
    gap = sixteen.filter("store_id = 's1' and date <> date'2016-01-05'")
    out = demand.with_sales_lags(gap, KEYS)
    # Row 8 is now January 9.
    assert column(out, ["date"], "sales_lag_7")[7] == 10


def test_store_city_map(spark, sixteen):
    places = spark.createDataFrame([("s1", "LA")], "store_id string, city string")
    placed = demand.attach_city(sixteen.drop("city"), places)
    assert placed.count() == 32
    assert {(r.store_id, r.city) for r in placed.select("store_id", "city").distinct().collect()} == {
        ("s1", "LA"), ("s2", None),
    }


def test_one_series_without_keys(sixteen, ten_days):
    """A single store and city joins on the date alone."""
    one = sixteen.filter("store_id = 's1'").drop("store_id")
    la = weather.mart_weather_daily(ten_days.filter("city = 'LA'"))
    mart = demand.mart_demand_features(one, la, [], on=(("date", "date"),))
    assert len(mart.columns) == 21
    assert column(mart, ["date"], "sales_lag_7")[7] == 10


def test_means_are_exact(spark, days):
    """20.1 three times is no anomaly of a month without spread; 15.1 and 15.2 average to 15.15, shown as 15.2."""
    flat = spark.createDataFrame([(d, "LA", 20.1, 5.0, None, None, 1) for d in days(3)], WEATHER)
    assert column(weather.mart_weather_daily(flat), ["date"], "anomaly_flag") == [0, 0, 0]
    pair = [(d, "LA", t, 5.0, None, None, 1) for d, t in zip(days(2), (15.1, 15.2))]
    mart = weather.mart_weather_daily(spark.createDataFrame(pair, WEATHER))
    assert column(mart, ["date"], "rolling_avg_temp_7d") == [15.1, 15.2]


def test_densify_dates_fills_the_days_of_each_series(spark):
    rows = [("s", "2016-01-01", 7), ("s", "2016-01-04", 1), ("t", "2016-02-28", 2), ("t", "2016-03-01", None), (None, "2016-05-01", 3), ("u", None, 4)]
    df = spark.createDataFrame(rows, "store_id string, date string, units_sold int").withColumn("date", F.col("date").cast("date"))
    got = demand.densify_dates(df, ["store_id"])
    assert got.columns == df.columns
    found = {(r.store_id, str(r.date)): r.units_sold for r in got.collect()}
    assert found == {
        ("s", "2016-01-01"): 7, ("s", "2016-01-02"): None, ("s", "2016-01-03"): None, ("s", "2016-01-04"): 1, ("t", "2016-02-28"): 2,
        ("t", "2016-02-29"): None, ("t", "2016-03-01"): None, (None, "2016-05-01"): 3,
    }
    assert demand.densify_dates(df.limit(0), ["store_id"]).count() == 0
