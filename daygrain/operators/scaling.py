"""Scalers whose fitted statistics are a table, so fit and transform may see different rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.numeric import nan_free
from daygrain.operators.blocks import attach
from daygrain.series import Series


def fit_min_max(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Minimum and scale per column; a constant column has scale 1 and so maps to 0."""
    low_high = nan_free(df, columns).groupBy(*series.keys).agg(
        *[F.min(c).alias(f"{c}__low") for c in columns],
        *[(F.max(c) - F.min(c)).alias(f"{c}__range") for c in columns],
    )
    return low_high.select(
        *series.keys,
        *[F.col(f"{c}__low").alias(f"{c}__shift") for c in columns],
        *[F.when(F.col(f"{c}__range") == 0, 1.0).otherwise(F.col(f"{c}__range")).alias(f"{c}__scale") for c in columns],
    )


def fit_standard(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column; a constant column has scale 1."""
    stats = nan_free(df, columns).groupBy(*series.keys).agg(
        *[F.avg(c).alias(f"{c}__shift") for c in columns], *[F.stddev_pop(c).alias(f"{c}__std") for c in columns]
    )
    return stats.select(
        *series.keys,
        *[f"{c}__shift" for c in columns],
        *[F.when(F.col(f"{c}__std") == 0, 1.0).otherwise(F.col(f"{c}__std")).alias(f"{c}__scale") for c in columns],
    )


def _apply(df: DataFrame, fitted: DataFrame, series: Series, columns: Sequence[str], inverse: bool) -> DataFrame:
    joined = attach(nan_free(df, columns), fitted, series)

    def change(c: str) -> Column:
        shift, scale = F.col(f"{c}__shift"), F.col(f"{c}__scale")
        return F.col(c) * scale + shift if inverse else (F.col(c) - shift) / scale

    chosen = set(columns)
    return joined.select(*[change(c).alias(c) if c in chosen else F.col(c) for c in df.columns])


def scale(df: DataFrame, fitted: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    return _apply(df, fitted, series, columns, False)


def unscale(df: DataFrame, fitted: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    return _apply(df, fitted, series, columns, True)
