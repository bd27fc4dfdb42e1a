"""Trend and multiplicative seasonality per series, with optional weather regressors.

Follows the published recipe (Taylor & Letham, "Forecasting at Scale", 2018): a piecewise linear
trend with 25 possible changes in the first 80 % of the history, yearly (order 10) and weekly
(order 3) Fourier terms, and regressors, where the effects scale the trend:

    y = trend * (1 + weekly + yearly + regressors)

Spark builds the design columns and groups the series; the fit is a small ridge regression per series,
alternating between trend and effects. Ridge stands in for the paper's priors, so digits differ.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast import fixed_values as fv
from tillcast.operators.features import is_train
from tillcast.operators.windows import whole_series

CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
# Ridge weights on y scaled to 1: noise variance 0.01 over the variances of the paper's priors
# (0.05 for trend changes, 5 for level and slope, 10 for effects).
CHANGE_PENALTY = 0.01 / 0.05**2
LEVEL_PENALTY = 0.01 / 5**2
EFFECT_PENALTY = 0.01 / 10**2
# The alternating fit ends when the effects move by no more than this.
FIT_ROUNDS = 500
FIT_CLOSE = 1e-11
PARTS = ("prediction", "trend", "weekly", "yearly")
EFFECTS = ("weekly", "yearly", "regressor")


def fourier(day: Column, period: float, order: int) -> Column:
    angle = [day * (2 * np.pi * n / period) for n in range(1, order + 1)]
    return F.array(*[f(a) for a in angle for f in (F.sin, F.cos)])


def seasonal_design(
    df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF, regressors: Sequence[str] = ()
) -> DataFrame:
    """Design columns as arrays. Time runs from 0 to 1 over the training days of each series;
    regressors are standardised by their training mean and deviation."""
    series = whole_series(keys)
    train = is_train(cutoff)
    day = F.datediff("date", F.lit("1970-01-01")).cast("double")
    first = F.min(F.when(train, day)).over(series)
    last = F.max(F.when(train, day)).over(series)
    time = F.try_divide(day - first, last - first)

    def standard(name: str) -> Column:
        known = F.when(train, F.col(name).cast("double"))
        deviation = F.stddev_samp(known).over(series)
        centred = F.col(name).cast("double") - F.avg(known).over(series)
        return F.coalesce(F.when(deviation > 0, centred / deviation), F.lit(0.0))

    steps = [CHANGEPOINT_RANGE * j / CHANGEPOINTS for j in range(1, CHANGEPOINTS + 1)]
    empty = F.array().cast(T.ArrayType(T.DoubleType()))
    return df.filter(F.col("date").isNotNull()).withColumn("_time", F.coalesce(time, F.lit(0.0))).select(
        *keys,
        "date",
        F.col("units_sold").cast("double").alias("y"),
        train.alias("train"),
        F.array(
            F.lit(1.0), F.col("_time"), *[F.greatest(F.col("_time") - s, F.lit(0.0)) for s in steps]
        ).alias("trend_terms"),
        fourier(day, *WEEKLY).alias("weekly_terms"),
        fourier(day, *YEARLY).alias("yearly_terms"),
        (F.array(*[standard(r) for r in regressors]) if regressors else empty).alias("regressor_terms"),
    )


def _ridge(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)


def fit_series(y: np.ndarray, trend_x: np.ndarray, effect_x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of trend and effects. With either part fixed the model is linear in the other."""
    trend_penalty = np.full(trend_x.shape[1], CHANGE_PENALTY)
    trend_penalty[:2] = LEVEL_PENALTY
    effect_penalty = np.full(effect_x.shape[1], EFFECT_PENALTY)
    effects = np.zeros(effect_x.shape[1])
    trend = np.zeros(trend_x.shape[1])
    for _ in range(FIT_ROUNDS):
        before = effects
        trend = _ridge(trend_x * (1 + effect_x @ effects)[:, None], y, trend_penalty)
        level = trend_x @ trend
        effects = _ridge(effect_x * level[:, None], y - level, effect_penalty)
        if np.abs(effects - before).max(initial=0.0) <= FIT_CLOSE:
            break
    return trend, effects


def _terms(group: pd.DataFrame) -> list[np.ndarray]:
    columns = ("trend_terms", "weekly_terms", "yearly_terms", "regressor_terms")
    return [np.array(group[c].tolist(), dtype=float).reshape(len(group), -1) for c in columns]


def _fit_group(group: pd.DataFrame):
    """(scale, trend coefficients, effect coefficients) of one series; None without a training day."""
    train = group["train"].to_numpy(bool) & group["y"].notna().to_numpy()
    if not train.any():
        return None
    trend_x, *effects = _terms(group)
    y = group["y"].to_numpy(float)
    scale = np.abs(y[train]).max() or 1.0
    return scale, *fit_series(y[train] / scale, trend_x[train], np.hstack(effects)[train])


def _forecast_group(group: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    test = ~group["train"].to_numpy(bool)
    out, fitted = group.loc[test, [*keys, "date"]], _fit_group(group)
    if fitted is None:
        return out.assign(**{part: np.nan for part in PARTS})
    scale, trend_coef, effect_coef = fitted
    trend_x, weekly, yearly, regressors = _terms(group)
    trend = trend_x @ trend_coef * scale
    n = weekly.shape[1]
    out["prediction"] = (trend * (1 + np.hstack([weekly, yearly, regressors]) @ effect_coef))[test]
    out["trend"] = trend[test]
    out["weekly"] = (weekly @ effect_coef[:n])[test]
    out["yearly"] = (yearly @ effect_coef[n : n + yearly.shape[1]])[test]
    return out


def _coefficient_group(group: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    fitted = _fit_group(group)
    if fitted is None:
        return pd.DataFrame(columns=[*keys, "part", "position", "value"])
    scale, trend, effects = fitted
    _, *terms = _terms(group)
    bounds = np.cumsum([0, *[t.shape[1] for t in terms]])
    parts = {"scale": [scale], "trend": trend}
    parts |= {name: effects[a:b] for name, a, b in zip(EFFECTS, bounds, bounds[1:])}
    rows = [(*group[keys].iloc[0], part, i, v) for part, values in parts.items() for i, v in enumerate(values)]
    return pd.DataFrame(rows, columns=[*keys, "part", "position", "value"])


def coefficients(
    df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF, regressors: Sequence[str] = ()
) -> DataFrame:
    """The fitted model as rows: series, part, position, value. The trend is of sales divided by `scale`."""
    design = seasonal_design(df, keys, cutoff, regressors)
    schema = T.StructType(
        [design.schema[k] for k in keys]
        + [T.StructField("part", T.StringType()), T.StructField("position", T.IntegerType()), T.StructField("value", T.DoubleType())]
    )
    key_names = list(keys)
    return design.groupBy(*keys).applyInPandas(lambda group: _coefficient_group(group, key_names), schema)


def _dot(terms: str, values: str) -> Column:
    products = F.zip_with(terms, values, lambda x, c: x * c)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def with_fit(design: DataFrame, fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`design` with the coefficients of its series as arrays and `level`, `weekly`, `yearly`, `extra`: the parts of the
    model as dot products, the level in units of `scale`. A series has some sixty coefficients."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "value")))
    arrays = fitted.groupBy(*keys, "part").agg(F.transform(ordered, lambda x: x["value"]).alias("values"))
    wide = arrays.groupBy(*keys).pivot("part", ["scale", "trend", *EFFECTS]).agg(F.first("values"))
    none = F.array().cast(T.ArrayType(T.DoubleType()))
    names = {part: F.coalesce(F.col(part), none).alias(f"{part}_values") for part in ("trend", *EFFECTS)}
    wide = wide.select(*keys, F.col("scale")[0].alias("scale"), *names.values())
    joined = design.join(wide, list(keys))
    return joined.withColumns({
        "level": _dot("trend_terms", "trend_values"), "weekly": _dot("weekly_terms", "weekly_values"),
        "yearly": _dot("yearly_terms", "yearly_values"), "extra": _dot("regressor_terms", "regressor_values"),
    })


def ridge_gradient(design: DataFrame, fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Half the gradient of the penalised squared error at the fitted coefficients, per series, part and position: 0
    where the fit is optimal. Summed over the training days where they lie."""
    train = with_fit(design, fitted, keys).filter(F.col("train") & F.col("y").isNotNull())
    share = 1 + F.col("weekly") + F.col("yearly") + F.col("extra")
    left = F.col("y") / F.col("scale") - F.col("level") * share
    slopes = {"trend": left * share, **{part: left * F.col("level") for part in EFFECTS}}

    def pull(part: str, slope: Column) -> Column:
        return F.transform(f"{part}_terms", lambda x, i: F.struct(
            F.lit(part).alias("part"), i.alias("position"), (x * slope).alias("pull")
        ))

    rows = F.flatten(F.array(*[pull(part, slope) for part, slope in slopes.items()]))
    pulls = train.select(*keys, F.explode(rows).alias("r")).groupBy(
        *keys, F.col("r.part").alias("part"), F.col("r.position").alias("position")
    ).agg(F.sum("r.pull").alias("pull"))
    level = (F.col("part") == "trend") & (F.col("position") < 2)
    penalty = F.when(level, LEVEL_PENALTY).when(F.col("part") == "trend", CHANGE_PENALTY).otherwise(EFFECT_PENALTY)
    return pulls.join(fitted, [*keys, "part", "position"]).select(
        *keys, "part", "position", (penalty * F.col("value") - F.col("pull")).alias("gradient")
    )


def recomposed(design: DataFrame, fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of `decompose` for every day, from the stored coefficients."""
    parts = with_fit(design, fitted, keys)
    trend = F.col("level") * F.col("scale")
    return parts.select(
        *keys, "date", "train", (trend * (1 + F.col("weekly") + F.col("yearly") + F.col("extra"))).alias("prediction"),
        trend.alias("trend"), "weekly", "yearly",
    )


def decompose(
    df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF, regressors: Sequence[str] = ()
) -> DataFrame:
    """Prediction, trend (units), weekly and yearly effect (shares of the trend) per test day."""
    design = seasonal_design(df, keys, cutoff, regressors)
    key_fields = [design.schema[k] for k in keys] + [design.schema["date"]]
    schema = T.StructType(key_fields + [T.StructField(p, T.DoubleType()) for p in PARTS])
    key_names = list(keys)
    return design.groupBy(*keys).applyInPandas(lambda group: _forecast_group(group, key_names), schema)


def forecast_seasonal(
    df: DataFrame, keys: Sequence[str], cutoff: str = fv.TRAIN_TEST_CUTOFF, regressors: Sequence[str] = ()
) -> DataFrame:
    return decompose(df, keys, cutoff, regressors).select(*keys, "date", "prediction")
