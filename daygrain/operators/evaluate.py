"""Forecast evaluation on long rows: keys, model, horizon_day, date, target_date, forecast, actual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.constants import TOLERANCES
from daygrain.functions.numeric import float_divide, nan_free
from daygrain.operators.blocks import lookup
from daygrain.operators.merging import one_truth
from daygrain.series import Series


def _error() -> Column:
    return F.col("actual") - F.col("forecast")


def percentage_error(eps: float = 0.0) -> Column:
    """Absolute error relative to the actual value; ``eps`` is added to the divisor."""
    return F.abs(float_divide(_error(), F.col("actual") + F.lit(eps)))


def scored(rows: DataFrame) -> DataFrame:
    """Rows that have both a forecast and an actual value."""
    rows = nan_free(rows, ["forecast", "actual"])
    return rows.where(F.col("forecast").isNotNull() & F.col("actual").isNotNull())


def horizon_metrics(rows: DataFrame, by: Sequence[str] = ("model",), eps: float = 0.0) -> DataFrame:
    """RMSE, MAE, R2 and MAPE (percent) per model and horizon: one aggregation, combined before the shuffle."""
    error = _error()
    spread = F.count("actual") * F.var_pop("actual")
    return scored(rows).groupBy(*by, "horizon_day").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.when(spread != 0, F.sum(error * error) / spread)).alias("r2"),
        (F.avg(percentage_error(eps)) * 100).alias("mape"),
    )


def overall_metrics(rows: DataFrame, by: Sequence[str] = ("model",), eps: float = 0.0) -> DataFrame:
    """RMSE, MAE and MAPE over all errors; R2 is the plain mean over the horizons.

    Pooled from the metrics per horizon, weighted by their number of rows: the rows are read once.
    """
    n = F.col("n")
    total = F.sum("n")
    return horizon_metrics(rows, by, eps).groupBy(*by).agg(
        total.alias("n"),
        F.sqrt(F.sum(n * F.col("rmse") * F.col("rmse")) / total).alias("rmse"),
        (F.sum(n * F.col("mae")) / total).alias("mae"),
        (F.sum(n * F.col("mape")) / total).alias("mape"),
        F.avg("r2").alias("r2"),
    )


def within_tolerance(
    rows: DataFrame, by: Sequence[str] = ("model",), tolerances: Sequence[float] = TOLERANCES
) -> DataFrame:
    """Share (percent) of errors within each tolerance, per horizon and averaged over horizons."""
    hit = [
        (F.avg(F.when(F.abs(_error()) <= t, 1.0).otherwise(0.0)) * 100).alias(f"t{i}")
        for i, t in enumerate(tolerances)
    ]
    per_horizon = scored(rows).groupBy(*by, "horizon_day").agg(*hit)
    entries = F.array(*[
        F.struct(F.lit(float(t)).alias("tolerance"), F.col(f"t{i}").alias("share")) for i, t in enumerate(tolerances)
    ])
    long = per_horizon.select(*by, "horizon_day", F.explode(entries).alias("e")).select(*by, "horizon_day", "e.*")
    average = long.groupBy(*by, "tolerance").agg(F.avg("share").alias("share"))
    return long.unionByName(average.withColumn("horizon_day", F.lit(None).cast("int")))


def best_and_worst_horizon(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return metrics.groupBy(*by).agg(
        F.min_by("horizon_day", F.struct("rmse", "horizon_day")).alias("best_day"),
        F.min("rmse").alias("best_rmse"),
        F.max_by("horizon_day", F.struct("rmse", -F.col("horizon_day"))).alias("worst_day"),
        F.max("rmse").alias("worst_rmse"),
    )


def compare_models(rows: DataFrame, models: Sequence[str], metric: str = "r2", eps: float = 1e-8) -> DataFrame:
    """One row per horizon, one column per model, holding the metric."""
    per_model = horizon_metrics(rows, eps=eps)
    return per_model.groupBy("horizon_day").pivot("model", list(models)).agg(F.first(metric))


def actual_vs_predicted(forecasts: DataFrame, truth: DataFrame, series: Series, value: str) -> DataFrame:
    """Forecast next to the true value, with the origin date and the target date."""
    known = one_truth(truth, series, value)
    rows = lookup(forecasts.drop("actual"), known, [*series.keys, "target_date"], "inner")
    return rows.withColumnRenamed("__actual", "actual")


def forecast_summary(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Range, mean and direction of a 7-day forecast."""
    ends = nan_free(rows, ["forecast"]).groupBy(*by).agg(
        F.min("forecast").alias("min_forecast"),
        F.max("forecast").alias("max_forecast"),
        F.avg("forecast").alias("mean_forecast"),
        F.min_by("forecast", "horizon_day").alias("__first"),
        F.max_by("forecast", "horizon_day").alias("__last"),
    )
    return ends.select(
        *by, "min_forecast", "max_forecast", "mean_forecast",
        F.when(F.col("__last") > F.col("__first"), "increasing").otherwise("decreasing").alias("trend"),
        F.abs(F.col("__last") - F.col("__first")).alias("change"),
    )
