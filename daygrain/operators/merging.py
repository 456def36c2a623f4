"""Joins of daily tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.operators.blocks import lookup
from daygrain.series import Series


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str]) -> DataFrame:
    """Full outer join in the order of ``on``; columns present on both sides get the suffixes."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, list(on), "full_outer").orderBy(*on)


def one_truth(truth: DataFrame, series: Series, value: str) -> DataFrame:
    """Actual value per (series, date); a repeated date keeps one value, so joins cannot multiply rows."""
    return truth.groupBy(*series.keys, F.col(series.time).alias("target_date")).agg(F.max(value).alias("__actual"))


def truth_for(truth: DataFrame, forecasts: DataFrame, series: Series, value: str) -> DataFrame:
    """Truth rows for the target dates that occur in the forecasts (a semi join, not an IN list)."""
    wanted = forecasts.select(*series.keys, "target_date").distinct()
    return lookup(one_truth(truth, series, value), wanted, [*series.keys, "target_date"], "left_semi")


def fill_actuals(forecasts: DataFrame, truth: DataFrame, series: Series, value: str) -> DataFrame:
    """``actual`` from the truth table by target date; rows without a match keep what they had."""
    known = truth_for(truth, forecasts, series, value)
    joined = lookup(forecasts, known, [*series.keys, "target_date"])
    actual = F.coalesce("__actual", "actual") if "actual" in forecasts.columns else F.col("__actual")
    return joined.withColumn("actual", actual).drop("__actual")
