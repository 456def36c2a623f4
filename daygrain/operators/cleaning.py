"""Column selection and cleaning of a raw panel."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain.constants import SENTINELS
from daygrain.functions.numeric import any_sentinel, is_missing, is_sentinel, nan_free
from daygrain.operators.blocks import attach
from daygrain.series import Series
from daygrain.sources.tables import require_columns

FLOATING = (T.DoubleType, T.FloatType)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def select_strict(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return require_columns(df, wanted).select(*wanted)


def drop_listed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    kinds = T.NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def missing_flag(df: DataFrame, column: str) -> Column:
    return is_missing(F.col(column), isinstance(df.schema[column].dataType, FLOATING))


def columns_with_nulls(df: DataFrame, max_null_fraction: float = 0.0) -> list[str]:
    """Names of the columns whose share of missing values exceeds the limit.

    One aggregate over all columns; one row comes back to the driver.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(missing_flag(df, c)).alias(c) for c in df.columns],
    ).first()
    return [c for c in df.columns if counted[c] > max_null_fraction * counted["__rows"]]


def drop_null_columns(df: DataFrame, max_null_fraction: float = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns with any missing value (or more than the given share), but for those to ``keep``.  Runs one job."""
    return df.drop(*[c for c in columns_with_nulls(df, max_null_fraction) if c not in set(keep)])


def latest_cutoff(df: DataFrame, series: Series, n: int = 3) -> DataFrame:
    """Per series, the time ``__cutoff`` from which on the latest ``n`` rows lie.

    It comes from distinct times and their counts: the latest ``n`` rows lie within the latest ``n`` distinct times,
    so one date repeated many times costs one row, not many.
    """
    latest = Window.partitionBy(*series.keys).orderBy(F.col(series.time).desc())
    times = df.where(F.col(series.time).isNotNull()).groupBy(*series.keys, series.time)
    ranked = (
        times.agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__at", F.row_number().over(latest))
        .where(F.col("__at") <= n)
    )
    newer = F.coalesce(F.sum("__n").over(latest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        ranked.withColumn("__newer", newer)
        .where(F.col("__newer") < n)
        .groupBy(*series.keys)
        .agg(F.min(series.time).alias("__cutoff"))
    )


def before_cutoff(time: str) -> Column:
    """Whether a row that carries its series' cutoff stays; rows without a time do."""
    return F.col(time).isNull() | F.col("__cutoff").isNull() | (F.col(time) < F.col("__cutoff"))


def drop_latest_times(df: DataFrame, series: Series, n: int = 3) -> DataFrame:
    """Remove the rows whose time is among the ``n`` largest, ties counted, of their series."""
    return attach(df, latest_cutoff(df, series, n), series).where(before_cutoff(series.time)).drop("__cutoff")


def rows_with_sentinel(df: DataFrame, columns: Sequence[str], sentinels: Sequence[float] = SENTINELS) -> DataFrame:
    return df.where(any_sentinel(columns, sentinels))


def sentinels_to_mean(
    df: DataFrame, series: Series, columns: Sequence[str], sentinels: Sequence[float] = SENTINELS
) -> DataFrame:
    """Replace sentinels by the mean of the other values of the column, per series.

    All means come from one aggregate; a column that holds only sentinels becomes null.
    """
    if not columns:
        return df
    df = nan_free(df, columns)
    means = df.groupBy(*series.keys).agg(*usual_means(columns, sentinels))
    return attach(df, means, series).select(*filled(df.columns, columns, sentinels))


def usual_means(columns: Sequence[str], sentinels: Sequence[float], where: Column | None = None) -> list[Column]:
    """Aggregates ``__mean_*``: the means of values that are no sentinels, of the rows ``where`` holds."""
    usable = lambda c: ~is_sentinel(F.col(c), sentinels) if where is None else where & ~is_sentinel(F.col(c), sentinels)
    return [F.avg(F.when(usable(c), F.col(c))).alias(f"__mean_{c}") for c in columns]


def filled(all_columns: Sequence[str], columns: Sequence[str], sentinels: Sequence[float]) -> list[Column]:
    """All columns, the listed ones with their ``__mean_*`` in place of sentinels."""
    chosen = set(columns)
    return [
        F.when(is_sentinel(F.col(c), sentinels), F.col(f"__mean_{c}")).otherwise(F.col(c).cast("double")).alias(c)
        if c in chosen else F.col(c)
        for c in all_columns
    ]


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any (listed) column."""
    return df.na.drop(subset=list(subset) if subset is not None else None)


def between_days(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    return df.where(F.col(time).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def outside_days(df: DataFrame, time: str, start: str, end: str, but_not: Sequence[str] = ()) -> DataFrame:
    """Rows outside a closed date range, without the listed single dates."""
    day = F.col(time)
    kept = (day < F.lit(start).cast("date")) | (day > F.lit(end).cast("date"))
    excluded = [day != F.lit(d).cast("date") for d in but_not]
    return df.where(reduce(lambda a, b: a & b, excluded, kept))


def sum_column(df: DataFrame, name: str, parts: Sequence[str]) -> DataFrame:
    return df.withColumn(name, reduce(lambda a, b: a + b, [F.col(c) for c in parts]))


def to_frame(spark, rows, schema=None) -> DataFrame:
    """A frame from a frame, a dict or a list of dicts (small scoring input)."""
    if isinstance(rows, DataFrame):
        return rows
    if isinstance(rows, dict):
        rows = [rows]
    if not isinstance(rows, list):
        raise TypeError("expected a DataFrame, a dict or a list of dicts")
    return spark.createDataFrame(rows, schema=schema)
