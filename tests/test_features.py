from datetime import date, timedelta
from statistics import mean, median

import pytest
from pyspark.sql import functions as F

from tillcast import fixed_values as fv
from tillcast.operators import features

KEYS = ["store_id"]
CUTOFF = "2016-02-01"
SCHEMA = (
    "store_id string, date date, units_sold bigint, snap_ca bigint, is_event bigint, day_of_week bigint, "
    "temperature_max double, precipitation_sum double, weather_code bigint, is_extreme_heat int, "
    "is_heavy_rain int, anomaly_flag int, sales_lag_7 bigint, sales_lag_14 bigint, "
    "sales_rolling_avg_7d double, sales_rolling_avg_14d double"
)


@pytest.fixture(scope="module")
def raw():
    """Two series over January and February, March only in the test period; some gaps."""
    rows = []
    for store, shift in (("s1", 0.0), ("s2", 50.0)):
        for i in range(70):
            day = date(2016, 1, 1) + timedelta(i)
            temperature = None if i % 17 == 5 else round(10 + shift + (i * 7 % 23) + 0.1 * (i % 3), 1)
            rain = None if i % 19 == 4 else float(i % 5)
            rows.append((
                store, day, 100 + i, i % 2, 0, i % 7 + 1, temperature, rain, i % 4, int(i % 9 == 0), int(i % 8 == 0),
                0, None if i < 7 else 93 + i, None if i < 14 else 86 + i, 1.0, 2.0,
            ))
    return rows


@pytest.fixture(scope="module")
def demand(spark, raw):
    return spark.createDataFrame(raw, SCHEMA)


def series(raw, store="s1"):
    return [r for r in raw if r[0] == store and r[13] is not None]


def collected(df, store="s1"):
    return df.filter(F.col("store_id") == store).orderBy("date").collect()


def test_warmup_then_neighbours(demand, raw):
    rows = collected(features.prepare_features(demand, KEYS))
    want = series(raw)
    assert len(rows) == len(want) == 56
    assert [r.tomorrow_temp for r in rows] == [w[6] for w in want[1:]] + [None]
    assert [r.tomorrow_precipitation for r in rows] == [w[7] for w in want[1:]] + [None]
    assert [r.tomorrow_heavy_rain for r in rows] == [w[10] for w in want[1:]] + [None]
    # The change starts over after the trimmed rows.
    assert [r.temp_change_3d for r in rows[:3]] == [None] * 3
    for i in range(3, 56):
        now, before = want[i][6], want[i - 3][6]
        expected = None if now is None or before is None else now - before
        assert rows[i].temp_change_3d == (expected if expected is None else pytest.approx(expected))


def test_split_is_complete(demand):
    train, test = features.split_by_date(features.drop_warmup(demand), CUTOFF)
    counts = {r.split: r.rows for r in features.split_counts(features.drop_warmup(demand), CUTOFF).collect()}
    assert counts == {"train": train.count(), "test": test.count()}
    assert sum(counts.values()) == 112
    assert train.agg(F.max("date")).first()[0] == date(2016, 1, 31)


def test_shocks_use_training_months_only(demand, raw):
    prepared = features.prepare_features(demand, KEYS)
    rows = collected(features.add_weather_shocks(prepared, KEYS, CUTOFF))
    january = mean(w[6] for w in series(raw) if w[1].month == 1 and w[6] is not None)
    for r, w in zip(rows, series(raw)):
        if w[1].month == 1 and w[6] is not None:
            assert r.temp_anomaly_from_monthly == pytest.approx(w[6] - january)
            assert r.unseasonable_heat == int(w[6] - january > 8)
        else:
            # February and March have no training days.
            assert r.temp_anomaly_from_monthly is None and r.unseasonable_heat == 0
        cold = w[6] is not None and w[6] < 15
        wet = w[7] is not None and w[7] > 2
        assert r.shopping_deterrence == 2 * wet + cold + (w[8] in fv.DETERRING_CODES)


def test_stored_baseline_gives_the_same(demand):
    prepared = features.prepare_features(demand, KEYS)
    baseline = features.monthly_baseline(prepared, KEYS, CUTOFF)
    joined = features.add_weather_shocks(prepared, KEYS, CUTOFF, baseline=baseline)
    window = features.add_weather_shocks(prepared, KEYS, CUTOFF)
    cols = ["store_id", "date", F.round("temp_anomaly_from_monthly", 6), "unseasonable_heat", "shopping_deterrence"]
    assert joined.count() == 112
    assert joined.select(cols).exceptAll(window.select(cols)).count() == 0


def test_median_fill(spark):
    rows = [("s", date(2015, 1, d), v) for d, v in enumerate([1.0, 2.0, 3.0, 10.0, None], 1)]
    rows += [("s", date(2016, 2, 1), None), ("s", date(2016, 2, 2), 99.0)]
    rows += [("t", date(2015, 1, 1), 7.0), ("t", date(2016, 2, 1), None)]
    df = spark.createDataFrame(rows, "store_id string, date date, v double")
    medians = features.train_medians(df, KEYS, ["v"], CUTOFF)
    assert {tuple(r) for r in medians.collect()} == {("s", 2.5), ("t", 7.0)}
    filled = features.impute_median(df, KEYS, ["v"], CUTOFF)
    got = [r.v for r in filled.orderBy("store_id", "date").collect()]
    assert got == [1.0, 2.0, 3.0, 10.0, 2.5, 2.5, 99.0, 7.0, 7.0]


def test_model_features_are_filled_per_series(demand, raw):
    rows = collected(features.model_features(demand, KEYS, CUTOFF))
    train = [w for w in series(raw) if w[1] < date(2016, 2, 1)]
    middle = median(w[6] for w in train if w[6] is not None)
    gaps = [r for r, w in zip(rows, series(raw)) if w[6] is None]
    assert gaps and all(r.temperature_max == pytest.approx(middle) for r in gaps)
    assert all(r[c] is not None for r in rows for c in fv.WEATHER_REGRESSORS)
    # Columns outside the seven keep their gaps until the boosted model fills zeros.
    assert rows[-1].tomorrow_extreme_heat is None
    zero = features.fill_zero(features.model_features(demand, KEYS, CUTOFF, impute=False), fv.WEATHER_FEATURES)
    assert all(r[c] is not None for r in collected(zero) for c in fv.WEATHER_FEATURES)


def test_all_features_share_one_shuffle(demand):
    plan = features.model_features(demand, KEYS, CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
