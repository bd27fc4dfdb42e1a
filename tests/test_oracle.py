"""Registered queries beside their SQL on the smallest tables, and on tables with hot keys."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import TABLES, compare, connect
from tillcast.plans import catalog
from tillcast.plans.oracle import all_oracles

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, all_oracles()
WITHOUT_SQL = {
    "forecast_seasonal", "forecast_seasonal_weather", "decomposition", "forecast_gbt", "forecast_gbt_weather",
    "feature_importance", "model_comparison",
}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no generated tables here")


def test_every_query_has_sql_or_is_a_trained_model():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_no_line_item_is_lost_in_the_matrix(spark):
    lines, orders = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders"))
    sold = lines.join(orders, F.expr("l_orderkey = o_orderkey")).agg(F.sum("l_quantity")).first()[0]
    assert QUERIES["sales_daily_totals"](spark, SF).agg(F.sum("units_sold")).first()[0] == sold


def test_boosted_queries_train_all_trees():
    import inspect

    assert "n_trees" not in inspect.getsource(catalog) and "REGISTERED" not in inspect.getsource(catalog)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, name, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the orders belongs to one customer and a third of the lines to one order."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "orders":
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey")).cast("bigint"))
        if name == "lineitem":
            hot = F.pmod(F.hash("l_orderkey", "l_linenumber"), F.lit(3)) == 0
            df = df.withColumn("l_orderkey", F.when(hot, 11).otherwise(F.col("l_orderkey")).cast("bigint"))
        df.coalesce(1).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", [
    "mart_weather_daily", "mart_demand_features", "features_impute", "sales_daily_totals", "forecast_metrics", "dq_report",
])
def test_hot_keys(spark, skewed, name):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{skewed}/{table}.parquet").exists():
            con.execute(f"create view {table} as select * from read_parquet('{skewed}/{table}.parquet/*.parquet')")
    assert compare(spark, con, skewed, name, QUERIES[name], SQL[name]) is None
