"""Forecast rows: wide scores to long rows, baselines, ensembles."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.constants import HORIZON
from daygrain.functions.numeric import nan_free
from daygrain.series import Series


def forecast_names(horizon: int = HORIZON, prefix: str = "t2m", names: Sequence[str] | None = None) -> list[str]:
    """Output names: the given list if it fits the number of horizons, else the default names."""
    if names is not None and len(names) == horizon:
        return list(names)
    return [f"{prefix}_d{h}_forecast" for h in range(1, horizon + 1)]


def to_long(wide: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """(keys, model, date) + one column per horizon -> one row per horizon with its target date."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("horizon_day"), F.col(c).cast("double").alias("forecast"))
        for i, c in enumerate(columns, start=1)
    ])
    long = wide.select(*series.keys, "model", F.col(series.time).alias("date"), F.explode(entries).alias("e"))
    return long.select(
        *series.keys, "model", "date",
        F.date_add("date", F.col("e.horizon_day")).alias("target_date"), "e.horizon_day", "e.forecast",
    )


def long_from_arrays(scores: DataFrame, series: Series, values: str = "scores") -> DataFrame:
    """The same from an array column; position in the array, counted in weeks of 7, is the horizon."""
    long = scores.select(
        *series.keys, "model", F.col(series.time).alias("date"), F.posexplode(values).alias("idx", "forecast")
    )
    horizon = (F.col("idx") % HORIZON + 1).cast("int")
    return long.select(
        *series.keys, "model", "date", F.date_add("date", horizon).alias("target_date"),
        horizon.alias("horizon_day"), F.col("forecast").cast("double").alias("forecast"),
    )


def pick_forecast(rows: DataFrame, candidates: Sequence[str], otherwise: Sequence[str] = ()) -> DataFrame:
    """``forecast`` = the first non-null of the candidate columns that exist, then of ``otherwise``
    (any numeric columns of the row)."""
    present = [F.col(c).cast("double") for c in [*candidates, *otherwise] if c in rows.columns]
    if not present:
        raise ValueError(f"none of {[*candidates, *otherwise]} among {rows.columns}")
    return rows.withColumn("forecast", F.coalesce(*present))


def ensemble_mean(rows: DataFrame, series: Series, models: Sequence[str], name: str = "ensemble") -> DataFrame:
    """Unweighted mean of the listed models per origin date and horizon, as rows of a new model.

    Only where each of them has a forecast: a mean of some is no ensemble of all.
    """
    names = sorted(set(models))
    given = nan_free(rows, ["forecast"]).where(F.col("model").isin(*names) & F.col("forecast").isNotNull())
    # a flag for each model: the sums stay plain numbers, which aggregate faster than sets
    found = [F.max(F.col("model") == m).alias(f"__has{i}") for i, m in enumerate(names)]
    means = given.groupBy(*series.keys, "date", "target_date", "horizon_day").agg(F.avg("forecast").alias("forecast"), *found)
    whole = F.expr(" AND ".join(f"__has{i}" for i in range(len(names))))
    return means.where(whole).drop(*[f"__has{i}" for i in range(len(names))]).withColumn("model", F.lit(name))


def persistence(df: DataFrame, series: Series, column: str, horizon: int = HORIZON) -> DataFrame:
    """Baseline: every coming day will be like today."""
    same = [F.col(column).alias(n) for n in forecast_names(horizon)]
    wide = df.select(*series.keys, series.time, F.lit("persistence").alias("model"), *same)
    return to_long(wide, series, forecast_names(horizon))


def horizon_of(column: str) -> int:
    """Horizon number inside a target name such as ``t2m_d3_forecast``."""
    found = re.search(r"_d(\d+)_forecast$", column)
    if not found:
        raise ValueError(f"{column} names no horizon")
    return int(found.group(1))
