"""Scalar column expressions. All are built-ins, so they stay inside whole-stage codegen."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast import fixed_values as fv


def col(name) -> Column:
    return name if isinstance(name, Column) else F.col(name)


def safe_date(text) -> Column:
    """Date of a `YYYY-M-D` string, NULL for anything else (Spark alone would take '2016')."""
    shaped = F.when(col(text).rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), col(text))
    return shaped.try_cast("date")


def rounded(value, digits: int = 1) -> Column:
    return F.round(col(value).cast("double"), digits)


def exact(value) -> Column:
    """The value as a decimal, for means: sums of doubles such as 20.1 miss exact halves and exact
    equality by an amount that depends on row order."""
    return col(value).cast("decimal(18,6)")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is NULL."""
    return F.when(condition, 1).otherwise(0)


def literal_map(values: dict) -> Column:
    """Constant map as one SQL literal: a call per entry would cost more than the query around it."""
    return F.expr("map(" + ", ".join(f"{k!r}, {v!r}" for k, v in values.items()) + ")")


def lookup(values: dict[int, str], key, default: str) -> Column:
    return F.coalesce(F.element_at(literal_map(values), col(key).cast("int")), F.lit(default))


def season(date) -> Column:
    """Meteorological season; NULL only for a NULL date."""
    month = F.month(col(date))
    # Not an array lookup: under ANSI, Spark 4.1 marks it as never NULL even for a NULL index.
    return F.coalesce(*[F.when(month.isin(months), name) for name, months in fv.SEASON_MONTHS.items()])


def weather_label(code) -> Column:
    return lookup(fv.WEATHER_LABELS, code, fv.UNKNOWN_LABEL)


def is_extreme_heat(temperature_max) -> Column:
    return flag(col(temperature_max) > fv.EXTREME_HEAT_ABOVE)


def is_heavy_rain(precipitation) -> Column:
    return flag(col(precipitation) > fv.HEAVY_RAIN_ABOVE)


def day_code(date) -> Column:
    """Day number of the retail week, 1 = Saturday."""
    return F.dayofweek(col(date)) % 7 + 1


def day_name(code) -> Column:
    return lookup(fv.DAY_NAMES, code, fv.UNKNOWN_LABEL)


def shopping_deterrence(precipitation, temperature_max, code=None) -> Column:
    """How much the weather keeps shoppers away; without `code` the score ends at 3, else at 4."""
    score = flag(col(precipitation) > fv.WET_ABOVE) * fv.WET_POINTS
    score = score + flag(col(temperature_max) < fv.COLD_BELOW)
    if code is not None:
        score = score + flag(col(code).isin(fv.DETERRING_CODES))
    return score


def unseasonable_heat(deviation) -> Column:
    return flag(col(deviation) > fv.UNSEASONABLE_HEAT_ABOVE)


def abs_error(actual, predicted) -> Column:
    return F.abs(col(actual) - col(predicted))


def relative_error(actual, predicted) -> Column:
    """abs((a - p) / a); NULL where the actual is 0."""
    return F.abs(F.try_divide((col(actual) - col(predicted)).cast("double"), col(actual)))


def error_pct(actual, predicted) -> Column:
    return F.try_divide(abs_error(actual, predicted).cast("double"), col(actual)) * 100


def demand_vs_average_pct(forecast, average) -> Column:
    """Forecast against the recent average in percent. A missing average counts as the forecast
    itself, and an average that is not positive gives 0."""
    forecast = col(forecast).cast("double")
    base = F.coalesce(col(average).cast("double"), forecast)
    return F.when(base > 0, (forecast - base) / base * 100).otherwise(F.lit(0.0))


def whole_units(value) -> Column:
    """Truncated to a whole number, for display."""
    return col(value).cast("bigint")


def fixed_1dp(value, plus: bool = False) -> Column:
    """Text with one decimal, correctly rounded from the binary value (0.15 -> 0.1, 0.25 -> 0.2).

    `format_string` rounds the decimal text half up instead. Here 20 * |x| is formed as 16|x| + 4|x|,
    both exact, with the rounding error of their sum; an odd whole sum is a tie that the error decides.
    """
    x = col(value).cast("double")
    size = F.abs(x)
    total = size * 16 + size * 4
    error = size * 4 - (total - size * 16)
    below = F.floor((total - 1) / 2)
    goes_up = (error > 0) | ((error == 0) & (below % 2 == 1))
    tie = total % 2 == 1
    tenths = F.when(tie, below + goes_up.cast("bigint")).otherwise(F.floor((total + 1) / 2))
    sign = F.when(x < 0, "-").otherwise("+" if plus else "")
    whole = F.floor(tenths / 10).cast("string")
    return F.concat(sign, whole, F.lit("."), (tenths % 10).cast("string"))


def feature_group(name) -> Column:
    expr = None
    for label, parts in fv.FEATURE_GROUPS:
        hit = F.lit(False)
        for part in parts:
            hit = hit | col(name).contains(part)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(fv.OTHER_FEATURE_GROUP)


def null_if_na_token(text, tokens: Sequence[str] = fv.NA_TOKENS) -> Column:
    return F.when(~col(text).isin(list(tokens)), col(text))
