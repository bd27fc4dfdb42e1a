from datetime import date

import pytest
from pyspark.sql import functions as F

from tillcast.operators import recommend

KEYS = ["store_id"]


@pytest.fixture(scope="module")
def inputs(spark, days):
    dates = days(20)
    forecasts = [(s, d, 100 + i, 110.5 + i) for s in ("s", "t") for i, d in enumerate(dates)]
    weather = [
        (s, d, 19.3, None if i == 2 else 0.0, int(i in (2, 5)), "Fog", "Winter", 0, 0)
        for s in ("s", "t") for i, d in enumerate(dates[:15])
    ]
    demand = [(s, d, int(i % 2), 0, i % 7 + 1, None if i == 0 else 100.0) for s in ("s", "t") for i, d in enumerate(dates)]
    return (
        spark.createDataFrame(
            forecasts, "store_id string, date date, actual_units_sold bigint, xgb_with_weather double"
        ),
        spark.createDataFrame(
            weather,
            "city string, date date, temperature_max double, precipitation_sum double, anomaly_flag int, "
            "weather_description string, season string, is_extreme_heat int, is_heavy_rain int",
        ),
        spark.createDataFrame(
            demand,
            "store_id string, date date, snap_ca bigint, is_event bigint, day_of_week bigint, "
            "sales_rolling_avg_7d double",
        ),
    )


def chosen(inputs, selection):
    df = recommend.resolve_dates(selection, *inputs, KEYS, "store_id")
    return sorted((r.store_id, r.date.day) for r in df.collect())


def test_date_selection(inputs):
    assert chosen(inputs, " Anomaly ") == [("s", 3), ("s", 6), ("t", 3), ("t", 6)]
    assert chosen(inputs, "SNAP") == [(s, d) for s in ("s", "t") for d in (2, 4, 6, 8, 10)]
    assert chosen(inputs, "2016-01-07, 2016-01-20,2016-1-3, 2016-01-99, 1999-01-01") == [
        ("s", 7), ("s", 20), ("t", 7), ("t", 20),
    ]
    assert chosen(inputs, "nothing") == []


def test_available_dates(inputs):
    assert tuple(recommend.available_dates(inputs[0]).first()) == (date(2016, 1, 1), date(2016, 1, 20), 20)


def test_context_and_prompt(inputs):
    dates = recommend.resolve_dates("2016-01-03,2016-01-01,2016-01-20", *inputs, KEYS, "store_id")
    context = recommend.recommendation_context(*inputs, KEYS, dates, city="store_id")
    assert context.count() == 6
    prompts = recommend.with_prompt(context, department=F.lit("FOODS"), city="store_id")
    rows = {r.date.day: r for r in prompts.filter("store_id = 's'").collect()}
    assert {r.store_id: r.prompt.split("\n\n")[0] for r in prompts.collect()} == {
        k: f"You are a supply chain intelligence system for the {k} FOODS \ndepartment in {k}." for k in ("s", "t")
    }
    assert rows[3].error_pct == pytest.approx(10.5 / 102 * 100)
    text = rows[3].prompt
    assert text.startswith("You are a supply chain intelligence system")
    assert "DATE: 2016-01-03 (Monday)\n" in text
    assert "- Forecasted demand: 112 units\n- Actual demand: 102 units\n- Demand vs 7-day average: +12.5%\n" in text
    assert "- Temperature: 19.3°C\n- Precipitation: nanmm\n- Conditions: Fog\n- Season: Winter\n" in text
    assert "- Weather anomaly: True\n- Extreme heat: False\n- Heavy rain: False\n" in text
    assert text.endswith("Be specific and operational.")
    # No average: compared with itself. No weather: flags unknown.
    assert "Demand vs 7-day average: +0.0%" in rows[1].prompt
    assert "Weather anomaly: Unknown" in rows[20].prompt and "Season: None" in rows[20].prompt


def test_headline(inputs):
    context = recommend.recommendation_context(*inputs, KEYS, city="store_id")
    row = recommend.headline(context).filter("store_id = 's' and date = date'2016-01-06'").first()
    assert row.headline == (
        "Forecast: 115 units | Actual: 105 units | Error: 10.0%\n"
        "Weather: 19.3°C, Fog\n"
        "Anomaly: True | SNAP: True | Event: False"
    )


def test_generation_retries_then_falls_back(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def answer(prompt):
        with open(calls / prompt, "a") as f:
            f.write("x")
        if prompt == "second" and len(open(calls / prompt).read()) < 2:
            raise RuntimeError("busy")
        if prompt == "never":
            raise RuntimeError("down")
        return prompt.upper()

    df = spark.createDataFrame([("first",), ("second",), ("never",), (None,)], "prompt string")
    got = {r.prompt: r.recommendation for r in recommend.generate(df, answer, wait=0.0, parallelism=2).collect()}
    assert got == {
        "first": "FIRST", "second": "SECOND", "never": "[Recommendation unavailable: down]", None: None,
    }
    assert [len(open(calls / p).read()) for p in ("first", "second", "never")] == [1, 2, 3]


def test_generation_runs_in_many_tasks(spark):
    df = spark.range(40, numPartitions=1).selectExpr("concat('p', id) as prompt")
    texts = recommend.generate(df, lambda p: p, wait=0.0)
    assert texts.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert recommend.generate(df, lambda p: p, wait=0.0, parallelism=3).rdd.getNumPartitions() == 3


def test_dates_restrict_the_forecasts_first(inputs):
    only = recommend.for_dates(inputs[0], recommend.parse_dates("2016-01-02"))
    assert only.count() == 2
    plan = recommend.recommendation_context(*inputs, KEYS, only.select("store_id", "date"), city="store_id")
    assert plan.filter(F.col("date") == date(2016, 1, 2)).count() == 2


def test_stored_answers_are_not_asked_again(spark, tmp_path):
    log, store = tmp_path / "calls", str(tmp_path / "answers")
    log.mkdir()

    def answer(prompt):
        import uuid

        (log / uuid.uuid4().hex).write_text(prompt)
        if prompt == "bad" and len([f for f in log.iterdir() if f.read_text() == "bad"]) < 3:
            raise ValueError("down")
        return prompt.upper()

    def called():
        return sorted(f.read_text() for f in log.iterdir())

    def run(prompts, retries=1):
        df = spark.createDataFrame(list(enumerate(prompts)), "n int, prompt string").repartition(3)
        out = recommend.generate_stored(df, answer, store, retries=retries, wait=0.0)
        assert out.columns == ["n", "prompt", "recommendation"]
        return [r.recommendation for r in out.orderBy("n").collect()]

    assert run(["a", "b", "a", None, "bad"]) == ["A", "B", "A", None, "[Recommendation unavailable: down]"]
    assert called() == ["a", "b", "bad"]  # equal prompts are asked once
    assert run(["b", "c", "a"]) == ["B", "C", "A"] and called() == ["a", "b", "bad", "c"]
    # A failed call is tried again by the next run, and then kept.
    assert run(["bad", "c"], retries=2) == ["BAD", "C"] and run(["bad"]) == ["BAD"]
    assert called().count("bad") == 3 and called().count("c") == 1
    assert run([]) == []
