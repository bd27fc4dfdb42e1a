import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.operators import quality
from tillcast.sources import files, tables

ARRAYS = {
    "time": ["2016-01-01", "2016-01-02"],
    "temperature_2m_max": [18.3, 19.5],
    "temperature_2m_min": [8.1, 9.0],
    "precipitation_sum": [0.0, None],
    "wind_speed_10m_max": [10.0, None],
    "weather_code": [3, None],
}


def payload(path, **changes):
    path.write_text(json.dumps({"latitude": 34.05, "daily": {**ARRAYS, **changes}}, indent=1))
    return str(path)


def test_wide_csv(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\nx,i,d,FOODS,CA_3,CA,5,\n")
    df = files.read_sales_wide(spark, str(path))
    assert dict(df.dtypes)["d_2"] == "int" and dict(df.dtypes)["store_id"] == "string"
    assert tuple(df.select("item_id", "d_1", "d_2").first()) == ("i", 5, None)
    path.write_text("item_id,d_1\ni,five\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_sales_wide(spark, str(path)).collect()


def test_wide_csv_of_full_width(spark, tmp_path):
    path = tmp_path / "wide.csv"
    days = [f"d_{i}" for i in range(1, 1942)]
    lines = [",".join(["item_id", "store_id", "cat_id", *days])]
    lines += [",".join([f"i{r}", "CA_3", "FOODS", *[str((r + i) % 5) for i in range(1941)]]) for r in range(20)]
    path.write_text("\n".join(lines))
    from tillcast.operators.reshape import melt_days

    long = melt_days(files.read_sales_wide(spark, str(path)))
    total = sum((r + i) % 5 for r in range(20) for i in range(1941))
    assert tuple(long.agg(F.count("*"), F.sum("units_sold")).first()) == (20 * 1941, total)


def test_files_of_another_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "sales"
    folder.mkdir()
    (folder / "a.csv").write_text("item_id,store_id,cat_id,d_1,d_2\na,s,c,1,2\n")
    (folder / "b.csv").write_text("item_id,store_id,cat_id,d_2,d_1\nb,s,c,2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_sales_wide(spark, str(folder)).collect()
    folder = tmp_path / "calendar"
    folder.mkdir()
    (folder / "a.csv").write_text("date,wday,event_name_1,snap_CA\n2016-01-01,7,,1\n")
    (folder / "b.csv").write_text("date,snap_CA,event_name_1,wday\n2016-01-02,1,,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_calendar(spark, str(folder)).collect()


def test_calendar_csv(spark, tmp_path):
    path = tmp_path / "calendar.csv"
    path.write_text(
        "date,wm_yr_wk,weekday,wday,month,year,event_name_1,snap_CA\n"
        "2016-01-01,1,Friday,7,1,2016,NewYear,0\n2016-01-02,1,Saturday,1,1,2016,,1\n2016-01-03,1,Sunday,2,1,2016,NA,1\n"
    )
    rows = files.read_calendar(spark, str(path)).orderBy("date").collect()
    assert [tuple(r) for r in rows] == [
        ("2016-01-01", 7, "NewYear", 0), ("2016-01-02", 1, None, 1), ("2016-01-03", 2, None, 1),
    ]


def test_weather_payload(spark, tmp_path):
    df = files.read_weather_json(spark, payload(tmp_path / "w.json"), "Los Angeles")
    assert [tuple(r) for r in df.orderBy("date").collect()] == [
        ("2016-01-01", "Los Angeles", 18.3, 8.1, 0.0, 10.0, 3),
        ("2016-01-02", "Los Angeles", 19.5, 9.0, None, None, None),
    ]


def test_weather_payloads_of_many_cities(spark, tmp_path):
    for city in ("Los Angeles", "10"):
        folder = tmp_path / "landing" / f"city={city}"
        folder.mkdir(parents=True)
        payload(folder / "a.json")
        payload(folder / "b.json", time=["2016-01-03", "2016-01-04"])
    df = files.read_weather_json(spark, str(tmp_path / "landing"))
    assert {(r.city, r["count"]) for r in df.groupBy("city").count().collect()} == {("Los Angeles", 4), ("10", 4)}


@pytest.mark.parametrize("changes", [{"weather_code": [1]}, {"precipitation_sum": None}])
def test_unequal_arrays_fail(spark, tmp_path, changes):
    with pytest.raises(Exception, match="differ in length"):
        files.read_weather_json(spark, payload(tmp_path / "w.json", **changes), "LA").collect()


def test_bronze_round_trip_widens(spark, tmp_path):
    rows = files.read_weather_json(spark, payload(tmp_path / "w.json"), "LA")
    path = str(tmp_path / "bronze" / "weather")
    tables.write_bronze(quality.conform(rows, schemas.BRONZE_WEATHER), path)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["temperature_max"] == "float"
    raw = files.read_bronze(spark, path, schemas.RAW_WEATHER)
    assert dict(raw.dtypes)["temperature_max"] == "double" and dict(raw.dtypes)["weather_code"] == "bigint"
    assert raw.filter("date = '2016-01-01'").first().temperature_max == pytest.approx(18.3, abs=1e-5)
    assert any(f.name.endswith(".snappy.parquet") for f in (tmp_path / path).iterdir())


def test_tables_are_replaced_and_described(spark):
    df = spark.createDataFrame([(date(2016, 1, 1), "LA"), (date(2016, 1, 5), "NY")], "date date, city string")
    for _ in range(2):
        facts = tables.materialize(df, "staging", "facts")
    assert facts == {
        "table": "weather_staging.facts", "rows": 2, "min_date": date(2016, 1, 1), "max_date": date(2016, 1, 5),
    }
    stored = tables.table(spark, "staging", "facts")
    assert stored.count() == 2
    stats = tables.table_stats(stored, city_col="city").first()
    assert (stats.rows, stats.cities, stats.city_names) == (2, 2, "LA, NY")
    assert [r.city for r in tables.preview(stored, ["date"], 1).collect()] == ["LA"]
    assert [r.city for r in tables.preview(stored, ["date"], 1, last=True).collect()] == ["NY"]


def test_bronze_has_a_bounded_number_of_folders(spark, tmp_path):
    path = str(tmp_path / "sales")
    rows = spark.range(10_000).selectExpr(
        "concat('s', id) as store_id", "'c' as cat_id", "date'2016-01-01' as date", "id as units_sold"
    )
    tables.write_bronze(rows, path, ["store_id", "cat_id"], buckets=16)
    tables.write_bronze(rows.limit(0), path, ["store_id", "cat_id"], buckets=16)
    folders = {f.name for f in (tmp_path / "sales").iterdir() if f.is_dir()}
    assert len(folders) == 16 and all(f.startswith("bucket=") for f in folders)
    files_before = {f: f.stat().st_mtime_ns for f in (tmp_path / "sales").rglob("*.parquet")}
    # One series is brought again: its rows are replaced, all others stay, and other folders are not touched.
    one = spark.sql("select 's77' as store_id, 'c' as cat_id, explode(array(date'2016-02-01', date'2016-02-02')) as date, 5L as units_sold")
    tables.write_bronze(one, path, ["store_id", "cat_id"], buckets=16)
    stored = files.read_bronze(spark, path, rows.schema)
    assert stored.columns == rows.columns and stored.count() == 10_001
    assert stored.filter("store_id <> 's77'").exceptAll(rows).count() == 0
    assert sorted(str(r.date) for r in stored.filter("store_id = 's77'").collect()) == ["2016-02-01", "2016-02-02"]
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "sales").rglob("*.parquet")}
    assert len({f.parent for f in set(files_before) ^ set(after)}) == 1


def test_a_failing_write_leaves_bronze(spark, tmp_path):
    path = str(tmp_path / "weather")
    good = spark.createDataFrame([("A", 1), ("B", 2)], "city string, v int")
    tables.write_bronze(good, path, ["city"])
    with pytest.raises(Exception, match="broken"):
        tables.write_bronze(good.withColumn("v", F.expr("if(city = 'B', raise_error('broken'), 9)").cast("int")), path, ["city"])
    assert files.read_bronze(spark, path, good.schema).exceptAll(good).count() == 0
