import pytest
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.operators import quality


def test_required_columns(spark):
    good = spark.createDataFrame([("2016-01-01", 1)], "date string, units_sold bigint")
    assert quality.require_not_null(good, ["date", "units_sold"]) is good
    bad = good.union(spark.createDataFrame([(None, 2)], "date string, units_sold bigint"))
    with pytest.raises(ValueError, match="date"):
        quality.require_not_null(bad, ["date", "units_sold"])
    assert quality.guard_not_null(good, ["date"]).count() == 1
    with pytest.raises(Exception, match="required column contains NULL: date"):
        quality.guard_not_null(bad, ["date"]).collect()


def test_conform(spark):
    df = spark.createDataFrame([("x", 3, "2016-01-01", 1, 1, 1)], "extra string, units_sold int, date string, snap_ca int, is_event int, day_of_week int")
    out = quality.conform(df, schemas.BRONZE_SALES)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.BRONZE_SALES.fields]
    with pytest.raises(ValueError, match="snap_ca"):
        quality.conform(df.drop("snap_ca"), schemas.BRONZE_SALES)
    text = df.withColumn("units_sold", F.lit("many"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        quality.conform(text, schemas.BRONZE_SALES).collect()


def test_conform_refuses_fractions(spark):
    schema = schemas.BRONZE_WEATHER
    rows = [("2016-01-01", "LA", 1.0, 0.0, None, None, code) for code in (3.0, None)]
    names = "date string, city string, temperature_max double, temperature_min double, precipitation_sum double, wind_speed_max double, weather_code double"
    out = quality.conform(spark.createDataFrame(rows, names), schema)
    assert sorted(r.weather_code or 0 for r in out.collect()) == [0, 3]
    broken = spark.createDataFrame([rows[0][:6] + (3.5,)], names)
    with pytest.raises(Exception, match="weather_code has a fraction"):
        quality.conform(broken, schema).collect()


def test_single_checks(spark):
    df = spark.createDataFrame(
        [("a", "Winter"), ("a", None), (None, "Monsoon"), (None, "Fall"), ("b", "Fall")], "k string, season string"
    )
    assert quality.check_not_null(df, "k").count() == 2
    assert [tuple(r) for r in quality.check_unique(df, ["k"]).collect()] == [("a", 2)]
    assert [r.season for r in quality.check_accepted(df, "season", ["Winter", "Fall"]).collect()] == ["Monsoon"]


def test_report(spark):
    sales = spark.createDataFrame(
        [("s", "2016-01-01", 1), ("s", "2016-01-01", None), ("t", "2016-01-01", 1), ("t", None, 2), ("t", None, 3)],
        "store_id string, date string, units_sold bigint",
    )
    tests = quality.standard_tests(["store_id"], ["city"])
    report = quality.run_checks({"stg_sales": sales, "untested": sales}, tests)
    got = {(r.table_name, r.column_name, r.test): r.failing_rows for r in report.collect()}
    assert got == {
        ("stg_sales", "date", "not_null"): 2,
        ("stg_sales", "units_sold", "not_null"): 1,
        ("stg_sales", "date", "unique"): 1,
    }
    with pytest.raises(ValueError, match="stg_sales.date unique: 1"):
        quality.require_checks(report)


def test_eighteen_data_tests():
    tests = quality.standard_tests(["store_id"], ["city"])
    assert sum(len(t.not_null) + bool(t.unique) + len(t.accepted) for t in tests.values()) == 18


def test_report_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "store_id string, date string, units_sold bigint")
    report = quality.run_checks({"stg_sales": empty}, quality.standard_tests(["store_id"], ["city"]))
    assert {r.failing_rows for r in report.collect()} == {0}
