"""Row-based windows over a daily series.

A series has at most one row per calendar day: sales rows are summed to that grain first and the
uniqueness test is required before the marts are built. A window partition is therefore bounded by the
number of days, however many sales a store has, and all windows of a job share one shuffle on the
series keys.
"""

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tillcast.functions.expressions import col


def by_date(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date")


def by_month(keys: Sequence[str]) -> WindowSpec:
    """Month of the year over all years. Nested in the series, so it needs no shuffle of its own."""
    return Window.partitionBy(*keys, F.month("date"))


def whole_series(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys)


def rolling_avg(value, n: int, keys: Sequence[str], digits: int = 1, include_current: bool = True) -> Column:
    """Mean of the last `n` rows; shorter at the start of a series. `include_current=False` ends the
    frame one row earlier, for a feature that must not contain its own day."""
    end = 0 if include_current else -1
    mean = F.avg(col(value)).over(by_date(keys).rowsBetween(end - n + 1, end))
    return F.round(mean, digits).cast("double")


def lag_feature(value, n: int, keys: Sequence[str]) -> Column:
    return F.lag(col(value), n).over(by_date(keys))


def lead_feature(value, n: int, keys: Sequence[str]) -> Column:
    return F.lead(col(value), n).over(by_date(keys))
