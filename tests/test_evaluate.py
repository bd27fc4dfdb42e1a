from datetime import date, timedelta

import numpy as np
import pytest

from tillcast import fixed_values as fv
from tillcast.operators import evaluate
from tillcast.operators.forecast import collect_predictions, forecast_naive, to_long
from tillcast.sources import tables

KEYS = ["store_id"]
LONG = "store_id string, date date, model string, actual bigint, predicted double, anomaly_flag int"


def long_frame(spark, pairs, model="m", flags=None):
    flags = flags or [0] * len(pairs)
    start = date(2016, 1, 1)
    rows = [("s", start + timedelta(i), model, a, float(p), f) for i, ((a, p), f) in enumerate(zip(pairs, flags))]
    return spark.createDataFrame(rows, LONG)


def test_metrics(spark):
    row = evaluate.forecast_metrics(long_frame(spark, [(100, 110), (200, 180), (400, 400)])).first()
    assert (row.rmse, row.mae, row.mape) == (pytest.approx(12.9099, abs=1e-4), 10.0, pytest.approx(6.6667, abs=1e-4))
    assert row.anomaly_mape is None and row.anomaly_days == 0 and row.days == 3


def test_metrics_with_anomaly_and_zero_actual(spark):
    long = long_frame(spark, [(100, 110), (0, 5), (200, 100)], flags=[0, 1, 1])
    row = evaluate.forecast_metrics(long).first()
    assert row.mape == pytest.approx(30.0) and row.anomaly_mape == pytest.approx(50.0)
    assert (row.zero_actual_days, row.anomaly_days, row.mae) == (1, 2, pytest.approx(115 / 3))


def test_summary_titles(spark):
    models = list(fv.MODEL_TITLES)
    long = long_frame(spark, [(100, 110)], models[0]).union(long_frame(spark, [(100, 150)], models[4]))
    rows = evaluate.model_summary(long).orderBy("position").collect()
    assert [(r.position, r.title, r.mae) for r in rows] == [
        (1, "Naive Baseline", 10.0), (5, "XGBoost (with weather)", 50.0),
    ]


def test_histogram_golden(spark):
    long = long_frame(spark, [(v, 0) for v in range(11)])
    bins = {r.bin: r.days for r in evaluate.residual_histogram(long).collect()}
    assert bins[13] == 1 and bins[25] == 1 and sum(bins.values()) == 11


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1000, 400), rng.integers(0, 500, 300)
    long = long_frame(spark, [(int(v), 7) for v in a], "a").union(long_frame(spark, [(int(v), 0) for v in b], "b"))
    rows = evaluate.residual_histogram(long).collect()
    for model, values in (("a", a - 7), ("b", b)):
        counts = np.zeros(25, int)
        for r in rows:
            if r.model == model:
                counts[r.bin - 1] = r.days
        assert counts.tolist() == np.histogram(values.astype(float), bins=25)[0].tolist()


def test_histogram_of_one_value(spark):
    row = evaluate.residual_histogram(long_frame(spark, [(5, 1), (6, 2)])).collect()
    assert sorted((r.bin, r.days) for r in row) == [(b, 2 if b == 13 else 0) for b in range(1, 26)]
    assert {(r.low, r.high) for r in row} == {(3.5, 4.5)}


def test_histogram_rows_are_not_shuffled_by_model(spark):
    plan = evaluate.residual_histogram(long_frame(spark, [(5, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_residual_sign_and_bounds(spark):
    long = long_frame(spark, [(100, 90), (50, 60), (10, 300)])
    assert evaluate.residual_stats(long).first().mean_residual == pytest.approx(-290 / 3)
    bounds = evaluate.scatter_bounds(long).first()
    assert (bounds.low, bounds.high) == (10.0, 300.0)


@pytest.fixture(scope="module")
def forecasts(spark, days):
    rows = [("s", d, 100 + i, 100.0) for i, d in enumerate(days(30))]
    return spark.createDataFrame(rows, "store_id string, date date, actual_units_sold bigint, p double")


@pytest.fixture(scope="module")
def weather(spark, days):
    rows = [("s", d, 36.5, 0.0, int(i == 3), 1, 0, "Fog") for i, d in enumerate(days(29))]
    return spark.createDataFrame(
        rows,
        "city string, date date, temperature_max double, precipitation_sum double, anomaly_flag int, "
        "is_extreme_heat int, is_heavy_rain int, weather_description string",
    )


def test_worst_days(forecasts, weather):
    rows = evaluate.worst_days(forecasts, weather, KEYS, "p", city="store_id").orderBy("error").collect()
    assert [r.error for r in rows] == [float(e) for e in range(10, 30)]
    # The last day has no weather but is the worst forecast.
    assert rows[-1].weather_description is None and rows[0].weather_description == "Fog"


def test_comparison_and_anomaly_labels(forecasts, weather):
    frame = evaluate.forecast_comparison(forecasts, weather, KEYS, ["p"], "store_id")
    assert frame.count() == 30 and "error_p" in frame.columns
    rows = evaluate.anomaly_days(frame).collect()
    # Python prints f"{36.5:.0f}" as 36.
    assert [r.label for r in rows] == ["36°C Fog"]


def test_long_and_wide_are_inverse(forecasts):
    long = to_long(forecasts.withColumnRenamed("p", "m1").selectExpr("*", "m1 + 1 as m2"), KEYS, ["m1", "m2"])
    assert long.count() == 60
    wide = tables.forecast_output(long, KEYS, ["m1", "m2"])
    assert wide.columns == ["store_id", "date", "actual_units_sold", "m1", "m2"]
    assert wide.filter("m2 = m1 + 1").count() == 30


def test_naive_repeats_the_last_training_value(spark, days):
    rows = [(s, d, base + i, 0) for s, base in (("s", 0), ("t", 500)) for i, d in enumerate(days(10))]
    df = spark.createDataFrame(rows, "store_id string, date date, units_sold bigint, anomaly_flag int")
    out = forecast_naive(df, KEYS, "2016-01-08")
    assert {(r.store_id, r.prediction) for r in out.collect()} == {("s", 6.0), ("t", 506.0)}
    assert out.count() == 6
    long = collect_predictions(df, {"naive_prediction": out}, KEYS, "2016-01-08")
    assert long.count() == 6 and set(long.columns) == {"store_id", "date", "model", "actual", "predicted", "anomaly_flag"}
