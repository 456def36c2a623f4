"""Data-quality reports: one aggregate over all columns, then one row per column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.constants import SENTINELS
from daygrain.functions.numeric import is_sentinel, nan_free
from daygrain.operators.cleaning import missing_flag, numeric_columns
from daygrain.series import Series


def _long(row: DataFrame, columns: Sequence[str], names: dict[str, str]) -> DataFrame:
    """The single wide row of per-column results as one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{k}").alias(v) for k, v in names.items()])
        for c in columns
    ]
    return row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def _per_column(
    df: DataFrame, columns: Sequence[str], aggregates: dict[str, Callable[[str], Column]]
) -> DataFrame:
    wide = df.agg(*[make(c).alias(f"{c}__{name}") for c in columns for name, make in aggregates.items()])
    return _long(wide, columns, {name: name for name in aggregates})


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    counted = _per_column(
        df, columns or df.columns, {"missing_count": lambda c: F.count_if(missing_flag(df, c))}
    )
    return counted.orderBy(F.desc("missing_count"), "column_name")


def sentinel_counts(
    df: DataFrame, columns: Sequence[str] | None = None, sentinels: Sequence[float] = SENTINELS
) -> DataFrame:
    chosen = columns or numeric_columns(df)
    return _per_column(
        df, chosen, {"missing_flag_count": lambda c: F.count_if(is_sentinel(F.col(c), sentinels))}
    )


def zero_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, columns or numeric_columns(df), {"zero_count": lambda c: F.count_if(F.col(c) == 0)})


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = columns or numeric_columns(df)
    return _per_column(
        nan_free(df, chosen), chosen,
        {"min": lambda c: F.min(F.col(c).cast("double")), "max": lambda c: F.max(F.col(c).cast("double"))},
    )


def duplicate_times(df: DataFrame, series: Series) -> DataFrame:
    """Per series: does a time repeat, and how many rows are repeats.

    Counts per (series, time) first, so a hot series is pre-aggregated and only one row per
    series is left to merge.
    """
    per_time = df.groupBy(*series.keys, series.time).agg(F.count(F.lit(1)).alias("n"))
    repeats = F.sum(F.col("n") - 1)
    return per_time.groupBy(*series.keys).agg(
        (repeats > 0).alias("has_duplicates"), repeats.alias("n_duplicates")
    )


def schema_report(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, type string")
