"""Data-quality, feature-selection and trend reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daygrain.operators import quality, stats
from daygrain.plans.features import feature_columns
from daygrain.series import Series
from daygrain.sources.tables import load_summary


def quality_report(df: DataFrame, series: Series) -> dict[str, DataFrame]:
    """Nulls, sentinels, zeros, ranges, duplicates, column types, and size and date range."""
    return {
        "nulls": quality.null_counts(df),
        "sentinels": quality.sentinel_counts(df),
        "zeros": quality.zero_counts(df),
        "ranges": quality.value_ranges(df),
        "duplicates": quality.duplicate_times(df, series),
        "types": quality.schema_report(df),
        "size": load_summary(df, series.time),
    }


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The per-column counts of the report side by side: one row per column."""
    joined = quality.null_counts(df, columns)
    for part in (quality.sentinel_counts(df, columns), quality.zero_counts(df, columns), quality.value_ranges(df, columns)):
        joined = joined.join(part, "column_name")
    return joined


def selection_report(
    df: DataFrame, target: str, features: Sequence[str] | None = None, min_abs_r: float = 0.3,
    top_matrix: int = 20, top_mi: int = 15, bins: int = 20,
) -> dict[str, DataFrame]:
    """Correlation ranking, matrix of the strongest features, and mutual information of the kept ones.

    The names chosen by correlation come back to the driver (one row per column) to form the
    next aggregate.  A column without a correlation, as a constant one, ranks last; its places in the matrix are null.  If no
    column is kept, the mutual information has no rows.
    """
    chosen = list(features) if features is not None else feature_columns(df)
    ranking = stats.correlations(df, chosen, target)
    ranked = ranking.collect()
    strong = [row.feature for row in ranked if row.abs_r is not None and row.abs_r > min_abs_r]
    leading = [target, *[row.feature for row in ranked]][:top_matrix]
    scores = stats.mutual_information(df, strong, target, bins)
    return {
        "correlation": ranking, "matrix": stats.correlation_matrix(df, leading),
        "mutual_information": stats.top_features(scores, "mi", top_mi),
    }


def trend_report(df: DataFrame, series: Series, column: str, degree: int = 10) -> DataFrame:
    """Yearly mean with its linear and polynomial trend."""
    yearly = stats.yearly_mean(df, series, column)
    linear = stats.linear_trend(yearly, series).withColumnRenamed("fitted", "linear")
    curve = stats.polynomial_trend(yearly, series, degree).withColumnRenamed("fitted", "polynomial").drop("mean")
    return linear.join(curve, [*series.keys, "year"])
