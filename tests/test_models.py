from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.operators import boosted, demand, evaluate, features, seasonal
from tillcast.operators.forecast import collect_predictions, forecast_all, forecast_naive

KEYS = ["store_id"]
CUTOFF = "2015-01-01"


@pytest.fixture(scope="module")
def history(spark):
    """Two series with trend, week and year, whose effects grow with the level."""
    rng = np.random.default_rng(1)
    rows = []
    for store, level in (("s", 1000.0), ("t", 80.0)):
        for i in range(1250):
            day = date(2012, 1, 1) + timedelta(i)
            week = 0.25 if day.weekday() >= 5 else -0.1
            year = float(0.15 * np.sin(2 * np.pi * i / 365.25))
            rain = float(i % 11 == 0) * 12
            units = level * (1 + i / 2000) * (1 + week + year - 0.01 * rain) + rng.normal(0, level * 0.02)
            rows.append((
                store, day, int(max(units, 0)), int(day.day <= 10), 0, (day.weekday() + 2) % 7 + 1, 15.0 + 10 * year,
                rain, 61 if rain else 0, 0, int(rain > 10), int(i % 97 == 0),
            ))
    schema = (
        "store_id string, date date, units_sold bigint, snap_ca bigint, is_event bigint, day_of_week bigint, "
        "temperature_max double, precipitation_sum double, weather_code bigint, is_extreme_heat int, "
        "is_heavy_rain int, anomaly_flag int"
    )
    df = spark.createDataFrame(rows, schema)
    mart = demand.with_sales_rolling(demand.with_sales_lags(df, KEYS), KEYS)
    return features.model_features(mart, KEYS, CUTOFF).cache()


def mape(history, predictions):
    long = collect_predictions(history, {"m": predictions}, KEYS, CUTOFF)
    return {r.store_id: r.mape for r in evaluate.forecast_metrics(long, KEYS).collect()}


def test_seasonal_beats_naive_on_each_series(history):
    naive = mape(history, forecast_naive(history, KEYS, CUTOFF))
    plain = mape(history, seasonal.forecast_seasonal(history, KEYS, CUTOFF))
    with_weather = mape(history, seasonal.forecast_seasonal(history, KEYS, CUTOFF, fv.WEATHER_REGRESSORS))
    for store in ("s", "t"):
        assert plain[store] < naive[store] / 2
        assert with_weather[store] < plain[store]
    assert max(with_weather.values()) < 4


def test_decomposition_recomposes_and_finds_the_week(history):
    parts = seasonal.decompose(history, KEYS, CUTOFF)
    tests = history.filter(~features.is_train(CUTOFF)).count()
    assert parts.count() == tests
    off = parts.select(F.max(F.abs(F.col("prediction") - F.expr("trend * (1 + weekly + yearly)")) / F.col("trend")))
    assert off.first()[0] < 1e-9
    week = parts.groupBy(F.dayofweek("date").isin(1, 7).alias("weekend")).agg(F.avg("weekly").alias("w"))
    effect = {r.weekend: r.w for r in week.collect()}
    assert effect[True] - effect[False] == pytest.approx(0.35, abs=0.08)


def test_seasonal_without_training_rows(spark):
    df = spark.createDataFrame([("s", date(2016, 1, 1), 5)], "store_id string, date date, units_sold bigint")
    assert [r.prediction for r in seasonal.forecast_seasonal(df, KEYS, CUTOFF).collect()] == [None]


def test_seasonal_fit_equals_plain_least_squares_when_additive_in_level():
    """Constant effects: the alternating fit must reach the trend of a direct solution."""
    t = np.linspace(0, 1, 200)
    x = np.column_stack([np.ones_like(t), t])
    y = 2 + 3 * t
    trend, effects = seasonal.fit_series(y, x, np.zeros((200, 1)))
    assert x @ trend == pytest.approx(y, abs=1e-2)
    assert effects == pytest.approx([0.0])


def test_boosted_beats_naive_and_ranks_features(history):
    predictions, model = boosted.forecast_boosted(history, KEYS, fv.WEATHER_FEATURES, CUTOFF, n_trees=15)
    naive = mape(history, forecast_naive(history, KEYS, CUTOFF))
    trees = mape(history, predictions)
    assert trees["s"] < naive["s"]
    table = boosted.feature_importance(history, model, fv.WEATHER_FEATURES)
    rows = table.collect()
    assert len(rows) == 19 and sum(r.importance for r in rows) == pytest.approx(1.0)
    top = boosted.top_features(table).collect()
    assert len(top) == 10 and top[0].importance == max(r.importance for r in rows)
    assert [r["rank"] for r in sorted(rows, key=lambda r: (-r.importance, r.feature))] == list(range(1, 20))
    assert model.getNumTrees == 15


def test_boosted_is_repeatable(history):
    one, _ = boosted.forecast_boosted(history, KEYS, fv.BASE_FEATURES, CUTOFF, n_trees=3)
    two, _ = boosted.forecast_boosted(history, KEYS, fv.BASE_FEATURES, CUTOFF, n_trees=3)
    assert one.exceptAll(two).count() == 0


def test_all_models_side_by_side(history):
    long, _ = forecast_all(history, KEYS, CUTOFF, n_trees=3)
    tests = history.filter(~features.is_train(CUTOFF)).count()
    assert {(r.model, r["count"]) for r in long.groupBy("model").count().collect()} == {
        (m, tests) for m in fv.MODEL_TITLES
    }
    assert long.filter("predicted is null").count() == 0
    assert [r.title for r in evaluate.model_summary(long).orderBy("position").collect()] == list(fv.MODEL_TITLES.values())


def test_seasonal_equals_a_fit_on_a_design_built_by_hand(history):
    """The same series outside Spark: time scale, change points, Fourier terms, standardised regressors."""
    rows = history.filter("store_id = 't'").orderBy("date").toPandas()
    day = np.array([(d - date(1970, 1, 1)).days for d in rows["date"]], float)
    train = np.array([d < date(2015, 1, 1) for d in rows["date"]])
    time = (day - day[train].min()) / (day[train].max() - day[train].min())
    trend_x = np.column_stack(
        [np.ones_like(time), time] + [np.maximum(time - 0.8 * j / 25, 0) for j in range(1, 26)]
    )
    waves = []
    for period, order in ((7.0, 3), (365.25, 10)):
        for n in range(1, order + 1):
            waves += [np.sin(2 * np.pi * n * day / period), np.cos(2 * np.pi * n * day / period)]
    for name in fv.WEATHER_REGRESSORS:
        x = rows[name].to_numpy(float)
        spread = x[train].std(ddof=1)
        waves.append((x - x[train].mean()) / spread if spread > 0 else np.zeros_like(x))
    effect_x = np.column_stack(waves)
    y = rows["units_sold"].to_numpy(float)
    scale = y[train].max()
    trend, effects = seasonal.fit_series(y[train] / scale, trend_x[train], effect_x[train])
    want = (trend_x @ trend * scale * (1 + effect_x @ effects))[~train]
    got = (
        seasonal.forecast_seasonal(history, KEYS, CUTOFF, fv.WEATHER_REGRESSORS)
        .filter("store_id = 't'").orderBy("date").toPandas()
    )
    assert list(got["date"]) == list(rows["date"][~train])
    assert got["prediction"].to_numpy() == pytest.approx(want, rel=1e-6)


def test_boosted_predictions_belong_to_their_rows(history):
    from pyspark.ml.linalg import Vectors

    predictions, model = boosted.forecast_boosted(history, KEYS, fv.WEATHER_FEATURES, CUTOFF, n_trees=3)
    got = {(r.store_id, r.date): r.prediction for r in predictions.collect()}
    rows = history.filter(~features.is_train(CUTOFF)).collect()
    assert len(got) == len(rows)
    for r in rows[::37]:
        vector = Vectors.dense([float(r[f] or 0) for f in fv.WEATHER_FEATURES])
        assert got[(r.store_id, r.date)] == pytest.approx(model.predict(vector))


def test_trainings_at_once_equal_those_one_after_the_other(history):
    long, model = forecast_all(history, KEYS, CUTOFF, n_trees=3)
    for name, columns in (("xgb_no_weather", fv.BASE_FEATURES), ("xgb_with_weather", fv.WEATHER_FEATURES)):
        alone, trained = boosted.forecast_boosted(history, KEYS, columns, CUTOFF, n_trees=3)
        got = long.filter(F.col("model") == name).select(*KEYS, "date", F.col("predicted").alias("prediction"))
        assert got.count() == alone.count() and got.exceptAll(alone).count() == 0
    assert trained.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]  # after the line with the name


def test_importance_follows_from_the_nodes(spark, history):
    _, model = boosted.forecast_boosted(history, KEYS, fv.WEATHER_FEATURES, CUTOFF, n_trees=4)
    nodes = boosted.tree_nodes(model, spark)
    assert nodes.select("tree").distinct().count() == 4
    assert nodes.filter("feature is null").count() == nodes.filter("feature is not null").count() + 4  # binary trees
    known = {r.feature: r for r in boosted.feature_importance(history, model, fv.WEATHER_FEATURES).collect()}
    again = {r.feature: r for r in boosted.importance_from_nodes(nodes, fv.WEATHER_FEATURES).collect()}
    assert known.keys() == again.keys()
    for name, row in known.items():
        assert again[name].importance == pytest.approx(row.importance, abs=1e-12)
        assert (again[name]["rank"], again[name].feature_group) == (row["rank"], row.feature_group)


@pytest.mark.parametrize("regressors", [(), tuple(fv.WEATHER_REGRESSORS)])
def test_fit_is_optimal_and_recomposes(history, regressors, monkeypatch):
    design = seasonal.seasonal_design(history, KEYS, CUTOFF, regressors)
    fitted = seasonal.coefficients(history, KEYS, CUTOFF, regressors).cache()
    assert fitted.count() == 2 * (1 + 27 + 6 + 20 + len(regressors))
    gradient = seasonal.ridge_gradient(design, fitted, KEYS)
    assert gradient.count() == 2 * (27 + 6 + 20 + len(regressors))
    assert gradient.agg(F.max(F.abs("gradient"))).first()[0] < 1e-7
    # Other coefficients are no optimum.
    moved = fitted.withColumn("value", F.col("value") * F.when(F.col("part") == "weekly", 1.01).otherwise(1.0))
    assert seasonal.ridge_gradient(design, moved, KEYS).agg(F.max(F.abs("gradient"))).first()[0] > 1e-3
    parts = seasonal.decompose(history, KEYS, CUTOFF, regressors)
    again = seasonal.recomposed(design, fitted, KEYS).filter("not train").select(*KEYS, "date", *[F.col(p).alias(f"{p}_2") for p in seasonal.PARTS])
    both = parts.join(again, [*KEYS, "date"])
    assert both.count() == parts.count()
    for p in seasonal.PARTS:
        assert both.agg(F.max(F.abs(F.col(p) - F.col(f"{p}_2")) / (1 + F.abs(p)))).first()[0] < 1e-9
