"""Required columns, schema conformance and data tests."""

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast import fixed_values as fv


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column, as rows, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "nulls")


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fails the job when a required column has a NULL; returns `df` unchanged otherwise."""
    bad = [r["column_name"] for r in null_counts(df, cols).filter("nulls > 0").collect()]
    if bad:
        raise ValueError(f"required columns contain NULL: {', '.join(sorted(bad))}")
    return df


def guard_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Same rule without a pass of its own: the job that reads the result fails at the first NULL."""
    guarded = {
        c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"required column contains NULL: {c}"))
        )
        for c in cols
    }
    return df.withColumns(guarded)


def _strict_cast(name: str, source: T.DataType, target: T.DataType) -> Column:
    """ANSI casts fail on bad text and overflow, but cut fractions; here a fraction is an error too."""
    value = F.col(name).cast(target)
    if isinstance(source, T.FractionalType) and isinstance(target, T.IntegralType):
        broken = F.raise_error(F.lit(f"column {name} has a fraction"))
        value = F.when(F.col(name).isNull() | (value == F.col(name)), value).otherwise(broken.cast(target))
    return value.alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order and type. A missing column or a lossy cast is an error,
    extra columns are dropped."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.select(*[_strict_cast(f.name, df.schema[f.name].dataType, f.dataType) for f in schema.fields])


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; keys with a NULL part are ignored."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.filter(known).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_accepted(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows outside the accepted values; NULL passes."""
    return df.filter(~F.col(col).isin(list(values)))


@dataclass(frozen=True)
class TableTests:
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: dict = field(default_factory=dict)


def standard_tests(sales_keys: Sequence[str], weather_keys: Sequence[str]) -> dict[str, TableTests]:
    """The data tests of the four models. With several series a date is unique per series."""
    sales = TableTests(not_null=["date", "units_sold"], unique=[*sales_keys, "date"])
    return {
        "stg_weather": TableTests(
            not_null=["date", "city", "temperature_max", "temperature_min"],
            unique=[*weather_keys, "date"],
        ),
        "stg_sales": sales,
        "mart_weather_daily": TableTests(
            not_null=["date", "temperature_range", "anomaly_flag", "season", "weather_description"],
            unique=[*weather_keys, "date"],
            accepted={"season": fv.SEASONS},
        ),
        "mart_demand_features": sales,
    }


def _table_report(name: str, df: DataFrame, tests: TableTests) -> DataFrame:
    """All tests of one table from one scan and one shuffle: counts per unique key first (combined
    before the shuffle, so a key repeated very often stays cheap), totals after."""
    row_tests = {("not_null", c): F.col(c).isNull() for c in tests.not_null}
    row_tests |= {("accepted_values", c): ~F.col(c).isin(list(v)) for c, v in tests.accepted.items()}
    failing = {f"t{i}": cond for i, cond in enumerate(row_tests.values())}
    per_key = df.groupBy(*tests.unique).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(cond).alias(t) for t, cond in failing.items()]
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in tests.unique], F.lit(True))
    totals = per_key.agg(
        F.count_if((F.col("n") > 1) & known).alias("dup"),
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in failing],
    )
    labels = [(test, c, t) for (test, c), t in zip(row_tests, failing)]
    if tests.unique:
        # The date is the tested column; the series keys only scope it.
        labels.append(("unique", tests.unique[-1], "dup"))
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(test).alias("test"),
            F.col(t).cast("bigint").alias("failing_rows"),
        )
        for test, c, t in labels
    ])
    return totals.select(F.inline(lines))


def run_checks(tables: dict[str, DataFrame], tests: dict[str, TableTests]) -> DataFrame:
    """(table_name, column_name, test, failing_rows) over all tables that have tests."""
    reports = [_table_report(name, df, tests[name]) for name, df in tables.items() if name in tests]
    return reduce(DataFrame.unionByName, reports)


def require_checks(report: DataFrame) -> None:
    """Raises when a data test fails. Windows over a series rely on one row per date."""
    bad = report.filter("failing_rows > 0").collect()
    if bad:
        lines = [f"{r.table_name}.{r.column_name} {r.test}: {r.failing_rows}" for r in bad]
        raise ValueError("data tests failed: " + "; ".join(sorted(lines)))
