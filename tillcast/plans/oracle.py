"""DuckDB SQL of the registered queries, built from shared common table expressions."""

import math
import re

from tillcast import fixed_values as fv
from tillcast.plans.adapters import CODES, CUTOFF
from tillcast.plans.catalog import DATE_LIST, STAND_IN_TITLES
from tillcast.schemas import DEMAND_WEATHER_COLUMNS, WEATHER_MART_COLUMNS


def _case(values: dict, key: str, default: str) -> str:
    whens = " ".join(f"when {k} then '{v}'" for k, v in values.items())
    return f"case {key} {whens} else '{default}' end"


def _safe_date(col: str) -> str:
    return rf"case when regexp_matches({col}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') then try_cast({col} as date) end"


def _weather_cols(prefix: str) -> str:
    return ", ".join(f"{prefix}.{c}" for c in DEMAND_WEATHER_COLUMNS)


def _stg_weather(source: str, date: str) -> str:
    return f"""
        select {date} as date, city,
               round(cast(temperature_max as double), 1) as temperature_max,
               round(cast(temperature_min as double), 1) as temperature_min,
               round(cast(precipitation_sum as double), 1) as precipitation_sum,
               round(cast(wind_speed_max as double), 1) as wind_speed_max,
               cast(weather_code as bigint) as weather_code
        from {source}
        where date is not null and temperature_max is not null and temperature_min is not null"""


def _stg_sales(source: str, date: str) -> str:
    return f"""
        select store_id, {date} as date, cast(units_sold as bigint) as units_sold,
               cast(snap_ca as bigint) as snap_ca, cast(is_event as bigint) as is_event,
               cast(day_of_week as bigint) as day_of_week
        from {source} where date is not null and units_sold is not null"""


_MONTH = "extract(month from date)"
_TRAIN = f"date < date '{CUTOFF}'"

CTES = {
    "regions": """
        select c_custkey, r_name from customer
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "sales_days": """
        select r_name as store_id, cast(o_orderdate as date) as date,
               cast(sum(l_quantity) as bigint) as units_sold,
               cast(max(case when extract(day from o_orderdate) <= 10 then 1 else 0 end) as int) as snap_ca,
               cast(max(case when o_orderpriority = '1-URGENT' and o_orderkey % 7 = 0 then 1 else 0 end) as int)
                   as is_event,
               cast(max((dayofweek(o_orderdate) + 1) % 7 + 1) as int) as day_of_week
        from lineitem join orders on l_orderkey = o_orderkey join regions on o_custkey = c_custkey
        group by r_name, cast(o_orderdate as date)""",
    "weather_seed": """
        select r_name as city, cast(o_orderdate as date) as date,
               cast(sum((o_orderkey * 31 + o_custkey) % 1000003) as bigint) as k
        from orders join regions on o_custkey = c_custkey group by r_name, cast(o_orderdate as date)""",
    "weather_heat": f"""
        select *, cast(320 - abs({_MONTH} - 7) * 25 + (k % 81) - 40
                       + case when k % 61 = 0 then 130 else 0 end as bigint) as tmax
        from weather_seed""",
    "weather_days_k": f"""
        select k, city, date, tmax / 10.0e0 as temperature_max,
               (tmax - 50 - k % 60) / 10.0e0 as temperature_min,
               case when k % 5 = 0 then (k % 250) / 10.0e0 when k % 97 = 0 then null else 0.0e0 end
                   as precipitation_sum,
               (50 + k % 200) / 10.0e0 as wind_speed_max,
               cast(([{', '.join(map(str, CODES))}])[cast(k % 20 as int) + 1] as int) as weather_code
        from weather_heat""",
    "raw_weather_rows": """
        select * replace (
            case when k % 101 = 0 then 'bad' when k % 103 = 0 then '2016' when k % 107 = 0 then null
                 else strftime(date, '%Y-%m-%d') end as date,
            case when k % 109 <> 0 then temperature_min end as temperature_min)
        from weather_days_k""",
    "raw_sales_rows": """
        select * replace (
            case when units_sold % 101 = 0 then 'bad' when units_sold % 103 = 0 then null
                 else strftime(date, '%Y-%m-%d') end as date,
            case when units_sold % 97 <> 0 then units_sold end as units_sold)
        from sales_days""",
    "stg_weather_bad": _stg_weather("raw_weather_rows", _safe_date("date")),
    "stg_sales_bad": _stg_sales("raw_sales_rows", _safe_date("date")),
    "stg_weather_rows": _stg_weather("weather_days_k", "date"),
    "stg_sales_rows": _stg_sales("sales_days", "date"),
    "weather_base": f"""
        select *, round(temperature_max - temperature_min, 1) as temperature_range,
               round(avg(cast(temperature_max as decimal(18,6))) over (partition by city order by date nulls first
                     rows between 6 preceding and current row), 1) as rolling_avg_temp_7d,
               lag(temperature_max, 3) over (partition by city order by date nulls first) as temp_lag_3,
               lag(temperature_max, 7) over (partition by city order by date nulls first) as temp_lag_7,
               avg(cast(temperature_max as decimal(18,6))) over (partition by city, {_MONTH}) as monthly_avg,
               stddev_samp(temperature_max) over (partition by city, {_MONTH}) as monthly_dev,
               case when {_MONTH} in (12, 1, 2) then 'Winter' when {_MONTH} in (3, 4, 5) then 'Spring'
                    when {_MONTH} in (6, 7, 8) then 'Summer' when {_MONTH} in (9, 10, 11) then 'Fall' end as season,
               case when temperature_max > {fv.EXTREME_HEAT_ABOVE} then 1 else 0 end as is_extreme_heat,
               case when precipitation_sum > {fv.HEAVY_RAIN_ABOVE} then 1 else 0 end as is_heavy_rain,
               {_case(fv.WEATHER_LABELS, 'weather_code', fv.UNKNOWN_LABEL)} as weather_description
        from stg_weather_rows""",
    "weather_mart": """
        select *, case when monthly_dev is not null and abs(temperature_max - monthly_avg) > 2 * monthly_dev
                       then 1 else 0 end as anomaly_flag
        from weather_base""",
    "joined_rows": f"""
        select s.store_id, s.date, s.units_sold, s.snap_ca, s.is_event, s.day_of_week, {_weather_cols('w')}
        from stg_sales_rows s left join weather_mart w on s.store_id = w.city and s.date = w.date""",
    "demand_mart": """
        select *,
               lag(units_sold, 7) over (partition by store_id order by date nulls first) as sales_lag_7,
               lag(units_sold, 14) over (partition by store_id order by date nulls first) as sales_lag_14,
               round(avg(units_sold) over (partition by store_id order by date nulls first
                     rows between 6 preceding and current row), 1) as sales_rolling_avg_7d,
               round(avg(units_sold) over (partition by store_id order by date nulls first
                     rows between 13 preceding and current row), 1) as sales_rolling_avg_14d
        from joined_rows""",
    "warm": "select * from demand_mart where sales_lag_7 is not null and sales_lag_14 is not null",
    "prepared": """
        select *, lead(temperature_max) over w as tomorrow_temp,
               lead(precipitation_sum) over w as tomorrow_precipitation,
               lead(is_extreme_heat) over w as tomorrow_extreme_heat,
               lead(is_heavy_rain) over w as tomorrow_heavy_rain,
               temperature_max - lag(temperature_max, 3) over w as temp_change_3d,
               cast(extract(month from date) as int) as month
        from warm window w as (partition by store_id order by date nulls first)""",
    "train_months": f"""
        select store_id, cast({_MONTH} as int) as month, avg(cast(temperature_max as decimal(18,6))) as mean_temp
        from warm where {_TRAIN} group by all""",
    "deviation": """
        select p.*, p.temperature_max - m.mean_temp as temp_anomaly_from_monthly
        from prepared p left join train_months m on p.store_id = m.store_id and p.month = m.month""",
    "shocks": f"""
        select *, case when temp_anomaly_from_monthly > {fv.UNSEASONABLE_HEAT_ABOVE} then 1 else 0 end
                      as unseasonable_heat,
               cast(case when precipitation_sum > 2 then 2 else 0 end
                    + case when temperature_max < 15 then 1 else 0 end as int) as deterrence_chart,
               cast(case when precipitation_sum > 2 then 2 else 0 end
                    + case when temperature_max < 15 then 1 else 0 end
                    + case when weather_code in ({', '.join(map(str, fv.DETERRING_CODES))}) then 1 else 0 end as int)
                   as shopping_deterrence
        from deviation""",
    "medians": "select store_id, "
    + ", ".join(f"cast(median({c}) as double) as {c}" for c in fv.WEATHER_REGRESSORS)
    + f" from shocks where {_TRAIN} group by store_id",
    "filled": "select s.* replace (" + ", ".join(
        f"coalesce(cast(s.{c} as double), m.{c}) as {c}" for c in fv.WEATHER_REGRESSORS
    ) + ") from shocks s left join medians m on s.store_id = m.store_id",
    "clock": f"""
        select *, cast(date_diff('day', date '1970-01-01', date) as double) as day,
               cast(min(case when {_TRAIN} then date_diff('day', date '1970-01-01', date) end) over s as double) as first_day,
               cast(max(case when {_TRAIN} then date_diff('day', date '1970-01-01', date) end) over s as double) as last_day
        from filled window s as (partition by store_id)""",
    "timed": """
        select *, coalesce(case when last_day > first_day then (day - first_day) / (last_day - first_day) end, 0e0) as time
        from clock""",
    "last_train": f"select store_id, arg_max(units_sold, date) as last_units from warm where {_TRAIN} group by store_id",
    "forecasts": f"""
        select w.store_id, w.date, w.units_sold as actual_units_sold, w.anomaly_flag,
               cast(l.last_units as double) as naive_prediction, cast(w.sales_lag_7 as double) as lag7_prediction
        from warm w left join last_train l on w.store_id = l.store_id where w.date >= date '{CUTOFF}'""",
    "long_rows": """
        select store_id, date, actual_units_sold as actual, anomaly_flag, 'naive_prediction' as model,
               naive_prediction as predicted from forecasts
        union all
        select store_id, date, actual_units_sold, anomaly_flag, 'lag7_prediction', lag7_prediction from forecasts""",
    "errors": "select *, actual - predicted as residual, case when actual <> 0 then abs((actual - predicted) / actual) end as share from long_rows",
    "ends": "select model, min(residual) as low, max(residual) as high from errors group by model",
    "bounds": """
        select model, case when low = high then low - 0.5 else low end as low,
               case when low = high then high + 0.5 else high end as high from ends""",
    "binned": """
        select e.model, least(cast(floor(25 * (e.residual - b.low) / (b.high - b.low)) as int) + 1, 25) as bin
        from errors e join bounds b on e.model = b.model where e.residual is not null""",
    "snap_days": """
        select f.store_id, f.date, row_number() over (partition by f.store_id order by f.date) as n
        from forecasts f left join demand_mart d on f.store_id = d.store_id and f.date = d.date
        where d.snap_ca = 1""",
    "context": """
        select f.store_id, f.date, f.actual_units_sold, f.lag7_prediction as forecasted_units,
               case when f.actual_units_sold <> 0
                    then abs(f.actual_units_sold - f.lag7_prediction) / f.actual_units_sold * 100 end as error_pct,
               w.temperature_max, w.precipitation_sum, w.anomaly_flag, w.weather_description, w.season,
               w.is_extreme_heat, w.is_heavy_rain, d.snap_ca, d.is_event, d.day_of_week, d.sales_rolling_avg_7d
        from forecasts f
        left join weather_mart w on f.store_id = w.city and f.date = w.date
        left join demand_mart d on f.store_id = d.store_id and f.date = d.date""",
    "matrix_sums": """
        select 'item_' || l_suppkey as item_id, r_name as store_id,
               case l_suppkey % 3 when 0 then 'A' when 1 then 'N' else 'R' end as cat_id,
               cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) + 1 as int) as n,
               cast(sum(l_quantity) as int) as units_sold
        from lineitem join orders on l_orderkey = o_orderkey join regions on o_custkey = c_custkey group by all""",
    "matrix_rows": """
        select i.item_id, i.store_id, i.cat_id, 'd_' || g.n as d, m.units_sold
        from (select distinct item_id, store_id, cat_id from matrix_sums) i
        cross join (select cast(unnest(range(1, 2407)) as int) as n) g
        left join matrix_sums m on m.item_id = i.item_id and m.store_id = i.store_id
                               and m.cat_id = i.cat_id and m.n = g.n""",
    "calendar_rows": """
        select strftime(day, '%Y-%m-%d') as date, cast((dayofweek(day) + 1) % 7 + 1 as int) as wday,
               case when day in (select cast(o_orderdate as date) from orders
                                 where o_orderpriority = '1-URGENT' and o_orderkey % 7 = 0) then 'Event' end
                   as event_name_1,
               case when extract(day from day) <= 10 then 1 else 0 end as snap_CA,
               'd_' || (date_diff('day', date '1995-01-01', day) + 1) as d
        from (select cast(unnest(generate_series(date '1995-01-01', date '2001-08-01', interval 1 day)) as date) as day)""",
    "matrix_days": """
        select m.*, c.date, c.snap_CA, c.event_name_1, c.wday,
               case when c.event_name_1 is not null then 1 else 0 end as is_event
        from matrix_rows m left join calendar_rows c on m.d = c.d""",
}

_DAILY = """
    date, cast(coalesce(sum(units_sold), 0) as bigint) as units_sold, cast(max(snap_CA) as bigint) as snap_ca,
    cast(max(is_event) as bigint) as is_event, cast(max(wday) as bigint) as day_of_week
    from matrix_days where date is not null"""
_METRICS = """
    round(sqrt(avg(residual * residual)), 6) as rmse, round(avg(abs(residual)), 6) as mae,
    round(avg(share) * 100, 6) as mape,
    round(avg(case when anomaly_flag = 1 then share end) * 100, 6) as anomaly_mape,
    count(residual) as days, count(case when anomaly_flag = 1 then residual end) as anomaly_days,
    count(case when actual = 0 then residual end) as zero_actual_days"""
_CHANGE = """case when coalesce(sales_rolling_avg_7d, forecasted_units) > 0
    then (forecasted_units - coalesce(sales_rolling_avg_7d, forecasted_units))
         / coalesce(sales_rolling_avg_7d, forecasted_units) * 100 else 0.0e0 end"""


def _truth(col: str) -> str:
    return f"case when {col} <> 0 then 'True' when {col} = 0 then 'False' else '{fv.UNKNOWN_LABEL}' end"


def _number(col: str) -> str:
    return f"coalesce(cast({col} as varchar), 'nan')"


def _prompt() -> str:
    parts = [
        "store_id", "'RETAIL'", "store_id",
        "strftime(date, '%Y-%m-%d')",
        _case(fv.DAY_NAMES, "day_of_week", fv.UNKNOWN_LABEL),
        "cast(cast(trunc(forecasted_units) as bigint) as varchar)",
        "cast(actual_units_sold as varchar)",
        f"printf('%+.1f', {_CHANGE})",
        _number("temperature_max"),
        _number("precipitation_sum"),
        "coalesce(weather_description, 'None')",
        "coalesce(season, 'None')",
        *[_truth(c) for c in ("anomaly_flag", "is_extreme_heat", "is_heavy_rain", "snap_ca", "is_event")],
    ]
    template = fv.PROMPT_TEMPLATE.replace("'", "''")
    return f"printf('{template}', {', '.join(parts)})"


_HEADLINE = f"""printf('Forecast: %s units | Actual: %s units | Error: %s%%',
        cast(cast(trunc(forecasted_units) as bigint) as varchar), cast(actual_units_sold as varchar),
        coalesce(printf('%.1f', error_pct), 'nan'))
    || chr(10) || printf('Weather: %s°C, %s', {_number('temperature_max')}, coalesce(weather_description, 'None'))
    || chr(10) || printf('Anomaly: %s | SNAP: %s | Event: %s',
        {_truth('anomaly_flag')}, {_truth('snap_ca')}, {_truth('is_event')})"""


def _dq_lines() -> str:
    def null(table, source, col):
        return f"""select '{table}' as table_name, '{col}' as column_name, 'not_null' as test,
                   count(*) as failing_rows from {source} where {col} is null"""

    def unique(table, source, key):
        return f"""select '{table}', 'date', 'unique', count(*) from
                   (select {key}, date from {source} where {key} is not null and date is not null
                    group by {key}, date having count(*) > 1)"""

    plan = [
        ("stg_weather", "stg_weather_bad", "city", ["date", "city", "temperature_max", "temperature_min"]),
        ("stg_sales", "stg_sales_bad", "store_id", ["date", "units_sold"]),
        ("mart_weather_daily", "weather_mart", "city",
         ["date", "temperature_range", "anomaly_flag", "season", "weather_description"]),
        ("mart_demand_features", "demand_mart", "store_id", ["date", "units_sold"]),
    ]
    lines = []
    for name, source, key, cols in plan:
        lines += [null(name, source, c) for c in cols] + [unique(name, source, key)]
    seasons = ", ".join(f"'{s}'" for s in fv.SEASONS)
    lines.append(
        f"select 'mart_weather_daily', 'season', 'accepted_values', count(*) from weather_mart "
        f"where season not in ({seasons})"
    )
    return " union all ".join(lines)


def _dates() -> str:
    # Only well-formed dates of the list can match.
    good = [p.strip() for p in DATE_LIST.split(",")]
    return ", ".join(f"'{d}'" for d in good)


_FEATURES_ZERO = ", ".join(
    f"round(coalesce({c}, 0), 6) as {c}" if c in ("temp_anomaly_from_monthly", "temp_change_3d")
    else f"coalesce({c}, 0) as {c}"
    for c in fv.WEATHER_FEATURES
)
_ALL_ZERO = ", ".join(f"round(coalesce(cast({c} as double), 0), 6) as {c}" for c in fv.WEATHER_FEATURES)


def _waves(name: str, period: float, order: int) -> list[str]:
    angles = [f"day * {2 * math.pi * n / period!r}e0" for n in range(1, order + 1)]
    calls = [f"{f}({a})" for a in angles for f in ("sin", "cos")]
    return [f"round({c}, 6) as {name}_{i}" for i, c in enumerate(calls)]


def _standard(c: str) -> str:
    known = f"case when {_TRAIN} then cast({c} as double) end"
    over = "over (partition by store_id)"
    return f"""coalesce(case when stddev_samp({known}) {over} > 0
        then (cast({c} as double) - avg({known}) {over}) / stddev_samp({known}) {over} end, 0e0)"""


# Published design: 25 trend changes in the first 80 % of the training time, weekly order 3, yearly order 10.
_DESIGN = ", ".join([
    "round(1e0, 6) as trend_0", "round(time, 6) as trend_1",
    *[f"round(greatest(time - {0.8 * j / 25!r}e0, 0e0), 6) as trend_{j + 1}" for j in range(1, 26)],
    *_waves("weekly", 7.0, 3), *_waves("yearly", 365.25, 10),
    *[f"round({_standard(c)}, 6) as regressor_{i}" for i, c in enumerate(fv.WEATHER_REGRESSORS)],
])
_GROUP = """case when regexp_matches(feature, 'tomorrow|weather|temp_anomaly|shopping|unseasonable') then 'weather'
    when regexp_matches(feature, 'sales|snap|event') then 'sales_calendar' else 'other' end"""
_SUMMARY_CASES = " ".join(f"when '{m}' then '{t}'" for m, t in STAND_IN_TITLES.items())
_SUMMARY_ORDER = " ".join(f"when '{m}' then {i + 1}" for i, m in enumerate(STAND_IN_TITLES))

SELECTS = {
    "sales_melt": "select item_id, store_id, d, units_sold from matrix_rows",
    "calendar_days": "select date, wday, event_name_1, snap_CA, d from calendar_rows",
    "sales_calendar_join": "select item_id, store_id, d, units_sold, date, snap_CA, event_name_1, wday, is_event from matrix_days",
    "sales_daily_totals": f"select store_id, cat_id, {_DAILY} group by store_id, cat_id, date",
    "csv_round_trip": "select item_id, store_id, d, units_sold, date, snap_CA, event_name_1, wday, is_event from matrix_days",
    "sales_series_daily": f"select {_DAILY} and store_id = 'ASIA' and cat_id = 'R' group by date",
    "weather_json_rows": """select strftime(date, '%Y-%m-%d') as date, city, temperature_max, temperature_min,
        precipitation_sum, wind_speed_max, weather_code from weather_days_k""",
    "bronze_weather": """select strftime(date, '%Y-%m-%d') as date, city,
        cast(cast(temperature_max as float) as double) as temperature_max,
        cast(cast(temperature_min as float) as double) as temperature_min,
        cast(cast(precipitation_sum as float) as double) as precipitation_sum,
        cast(cast(wind_speed_max as float) as double) as wind_speed_max,
        cast(weather_code as bigint) as weather_code from weather_days_k""",
    "bronze_round_trip": """select strftime(date, '%Y-%m-%d') as date, city,
        cast(cast(temperature_max as float) as double) as temperature_max,
        cast(cast(temperature_min as float) as double) as temperature_min,
        cast(cast(precipitation_sum as float) as double) as precipitation_sum,
        cast(cast(wind_speed_max as float) as double) as wind_speed_max,
        cast(weather_code as bigint) as weather_code from weather_days_k where city <> 'ASIA' or date >= date '1998-01-01'""",
    "pipeline_tables": """
        with w as (select count(*) as rows, cast(min(date) as varchar) as first_day, cast(max(date) as varchar) as last_day
            from weather_days_k),
        s as (select (select count(*) from (select distinct store_id, cat_id from matrix_sums)) * (select count(*) from calendar_rows)
            as rows, (select min(date) from calendar_rows) as first_day, (select max(date) from calendar_rows) as last_day)
        select t as table_name, w.* from w, (values ('weather_raw.weather_raw_daily'), ('weather_staging.stg_weather'),
            ('weather_marts.mart_weather_daily')) as x(t)
        union all
        select t, s.* from s, (values ('sales_raw.sales_raw_daily'), ('weather_staging.stg_sales'),
            ('weather_marts.mart_demand_features')) as x(t)""",
    "sales_densified": """
        with d as (select store_id, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
            from stg_sales_bad group by store_id)
        select d.store_id, d.date, b.units_sold,
            round(avg(b.units_sold) over (partition by d.store_id order by d.date rows between 6 preceding and current row), 1)
                as sales_rolling_avg_7d
        from d left join stg_sales_bad b on b.store_id = d.store_id and b.date = d.date""",
    "seasonal_gradient": """
        select store_id, p.part, cast(unnest(range(0, p.n)) as int) as position, 0e0 as gradient
        from (select distinct store_id from warm),
            (values ('trend', 27), ('weekly', 6), ('yearly', 20), ('regressor', 7)) as p(part, n)""",
    "decomposition_identity": """select store_id, date, 0e0 as prediction, 0e0 as trend, 0e0 as weekly, 0e0 as yearly
        from forecasts""",
    "importance_identity": """select cast(unnest(range(1, 20)) as int) as rank, 0e0 as difference,
        cast(unnest(range(1, 20)) as int) as again_rank, 1e0 as total""",
    "bronze_sales": """select store_id, strftime(date, '%Y-%m-%d') as date, units_sold, cast(snap_ca as bigint) as snap_ca,
        cast(is_event as bigint) as is_event, cast(day_of_week as bigint) as day_of_week from sales_days""",
    "required_nulls": " union all ".join(
        f"select '{c}' as column_name, count(*) as nulls from raw_weather_rows where {c} is null"
        for c in ("date", "city", "temperature_max", "temperature_min")
    ),
    "stg_weather": "select * from stg_weather_bad",
    "stg_sales": "select * from stg_sales_bad",
    "weather_rolling": "select city, date, rolling_avg_temp_7d from weather_base",
    "weather_lags": "select city, date, temp_lag_3, temp_lag_7 from weather_base",
    "weather_monthly_stats": f"""select city, cast({_MONTH} as int) as month,
        round(avg(cast(temperature_max as decimal(18,6))), 6) as monthly_avg_temp,
        round(stddev_samp(temperature_max), 6) as monthly_stddev_temp from stg_weather_rows group by all""",
    "weather_anomaly": "select city, date, anomaly_flag from weather_mart",
    "weather_labels": """select city, date, temperature_range, season, is_extreme_heat, is_heavy_rain,
        weather_description from weather_base""",
    "mart_weather_daily": f"select {', '.join(WEATHER_MART_COLUMNS)} from weather_mart",
    "demand_join": "select * from joined_rows",
    "sales_lags": "select store_id, date, sales_lag_7, sales_lag_14 from demand_mart",
    "sales_rolling": "select store_id, date, sales_rolling_avg_7d, sales_rolling_avg_14d from demand_mart",
    "sales_rolling_known": """select store_id, date,
        round(avg(units_sold) over (partition by store_id order by date nulls first
              rows between 7 preceding and 1 preceding), 1) as sales_rolling_avg_7d,
        round(avg(units_sold) over (partition by store_id order by date nulls first
              rows between 14 preceding and 1 preceding), 1) as sales_rolling_avg_14d
        from stg_sales_rows""",
    "mart_demand_features": "select * from demand_mart",
    "features_lead": """select store_id, date, tomorrow_temp, tomorrow_precipitation, tomorrow_extreme_heat,
        tomorrow_heavy_rain, round(temp_change_3d, 6) as temp_change_3d from prepared""",
    "features_shock": """select store_id, date, month, round(temp_anomaly_from_monthly, 6) as temp_anomaly_from_monthly,
        unseasonable_heat, shopping_deterrence from shocks""",
    "features_shock_chart": """select store_id, date, month,
        round(temp_anomaly_from_monthly, 6) as temp_anomaly_from_monthly,
        unseasonable_heat, deterrence_chart as shopping_deterrence from shocks""",
    "monthly_baseline": "select store_id, month, round(mean_temp, 6) as monthly_mean_temp from train_months",
    "train_medians": "select store_id, "
    + ", ".join(f"round({c}, 6) as {c}" for c in fv.WEATHER_REGRESSORS) + " from medians",
    "features_impute": "select s.store_id, s.date, "
    + ", ".join(f"round(coalesce(cast(s.{c} as double), m.{c}), 6) as {c}" for c in fv.WEATHER_REGRESSORS)
    + " from shocks s left join medians m on s.store_id = m.store_id",
    "features_fill_zero": f"select store_id, date, {_FEATURES_ZERO} from shocks",
    "seasonal_design": f"""select store_id, date, cast(units_sold as double) as y, {_TRAIN} as train, {_DESIGN}
        from timed""",
    "boosted_matrix": f"""select store_id, date, cast(units_sold as double) as label, {_TRAIN} as train, {_ALL_ZERO}
        from filled""",
    "feature_profile": f"select *, {_GROUP} as feature_group from (" + " union all ".join(
        f"""select '{c}' as feature, count(*) - count({c}) as gaps,
            round(avg(coalesce(cast({c} as double), 0)), 6) as mean from shocks where {_TRAIN}"""
        for c in fv.WEATHER_FEATURES
    ) + ")",
    "chart_features": "select store_id, date, "
    + _FEATURES_ZERO.replace("coalesce(shopping_deterrence, 0)", "coalesce(deterrence_chart, 0)") + " from shocks",
    "split_counts": f"""select case when {_TRAIN} then 'train' else 'test' end as split, count(*) as rows,
        min(date) as min_date, max(date) as max_date from warm group by 1""",
    "split_series": f"""select store_id, date, units_sold, case when {_TRAIN} then 'train' else 'test' end as split
        from warm""",
    "forecast_naive": "select store_id, date, naive_prediction as prediction from forecasts",
    "forecast_output": "select store_id, date, actual_units_sold, naive_prediction, lag7_prediction from forecasts",
    "forecast_metrics": f"select model, {_METRICS} from errors group by model",
    "forecast_metrics_by_store": f"select store_id, model, {_METRICS} from errors group by store_id, model",
    "model_summary": f"""select cast(case model {_SUMMARY_ORDER} end as int) as position,
        case model {_SUMMARY_CASES} end as title, round(sqrt(avg(residual * residual)), 6) as rmse,
        round(avg(abs(residual)), 6) as mae, round(avg(share) * 100, 6) as mape from errors group by model""",
    "residuals": "select store_id, date, model, residual from errors",
    "residual_stats": "select model, round(avg(residual), 6) as mean_residual, count(residual) as days from errors group by model",
    "residual_histogram": """select b.model, g.bin, b.low, b.high,
        (select count(*) from binned n where n.model = b.model and n.bin = g.bin) as days
        from bounds b cross join (select cast(unnest(range(1, 26)) as int) as bin) g""",
    "scatter_bounds": """select model, cast(least(min(actual), min(predicted)) as double) as low,
        cast(greatest(max(actual), max(predicted)) as double) as high, round(avg(share) * 100, 6) as mape
        from errors group by model""",
    "actual_vs_predicted": "select store_id, date, model, actual, predicted from long_rows",
    "forecast_comparison": """select f.store_id, f.date, f.actual_units_sold, f.naive_prediction, f.lag7_prediction,
        abs(f.actual_units_sold - f.naive_prediction) as error_naive_prediction,
        abs(f.actual_units_sold - f.lag7_prediction) as error_lag7_prediction,
        w.anomaly_flag, w.weather_description, w.temperature_max, w.precipitation_sum
        from forecasts f left join weather_mart w on f.store_id = w.city and f.date = w.date""",
    "anomaly_days": """select f.store_id, f.date, f.actual_units_sold,
        printf('%.0f°C', w.temperature_max) || ' ' || w.weather_description as label
        from forecasts f left join weather_mart w on f.store_id = w.city and f.date = w.date where w.anomaly_flag = 1""",
    "worst_days": """select f.store_id, f.date, f.actual_units_sold, f.lag7_prediction,
        abs(f.actual_units_sold - f.lag7_prediction) as error, w.temperature_max, w.precipitation_sum, w.anomaly_flag,
        w.is_extreme_heat, w.is_heavy_rain, w.weather_description
        from forecasts f left join weather_mart w on f.store_id = w.city and f.date = w.date
        order by error desc nulls last, f.date, f.store_id limit 20""",
    "available_dates": "select min(date) as start_date, max(date) as end_date, count(distinct date) as total_days from forecasts",
    "dates_anomaly": """select f.store_id, f.date from forecasts f
        left join weather_mart w on f.store_id = w.city and f.date = w.date where w.anomaly_flag = 1""",
    "dates_snap": f"select store_id, date from snap_days where n <= {fv.SNAP_DAYS_SHOWN}",
    "dates_list": f"select store_id, date from forecasts where cast(date as varchar) in ({_dates()})",
    "recommendation_context": "select * replace (round(error_pct, 6) as error_pct) from context",
    "recommendation_prompt": f"select store_id, date, {_prompt()} as prompt, {_HEADLINE} as headline from context",
    "recommendation_generate": f"""select store_id, date,
        case when coalesce(weather_description, 'None') = '{fv.UNKNOWN_LABEL}'
             then '[Recommendation unavailable: no weather]'
             else length({_prompt()}) || ' characters' end as recommendation
        from context where anomaly_flag = 1""",
    "dq_report": _dq_lines(),
    "table_stats": """select count(*) as rows, min(date) as min_date, max(date) as max_date,
        count(distinct city) as cities, string_agg(distinct city, ', ' order by city) as city_names from weather_mart""",
    "table_stats_by_city": """select city, count(*) as rows, min(date) as min_date, max(date) as max_date
        from weather_mart group by city""",
    "series_head": "select * from stg_sales_rows order by date, store_id limit 5",
    "series_tail": "select * from stg_sales_rows order by date desc, store_id desc limit 5",
}


def _needed(sql: str, found: dict[str, None]) -> dict[str, None]:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            found[name] = None
    return found


def oracle(name: str) -> str:
    """The statement with the expressions it needs, in dependency order."""
    select = SELECTS[name]
    found = _needed(select, {})
    if not found:
        return select
    ctes = ",\n".join(f"{c} as ({CTES[c].strip()})" for c in found)
    return f"with {ctes}\nselect * from ({select})"


def all_oracles() -> dict[str, str]:
    return {name: oracle(name) for name in SELECTS}
