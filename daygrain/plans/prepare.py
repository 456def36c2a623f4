"""Raw wide table to clean table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.constants import INCOMPLETE_COLUMNS, SENTINELS, ZERO_COLUMNS
from daygrain.functions.calendar import calendar_columns
from daygrain.functions.numeric import nan_free
from daygrain.operators.blocks import add_series_stats, attach
from daygrain.operators.cleaning import (
    before_cutoff, drop_listed, drop_null_columns, filled, latest_cutoff, lower_names, numeric_columns, sum_column, usual_means,
)
from daygrain.series import Series
from daygrain.session import written


def add_calendar(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns(calendar_columns(time))


def prepare(
    raw: DataFrame, series: Series, latest: int = 3, sentinels: Sequence[float] = SENTINELS,
    max_null_fraction: float = 0.0,
) -> DataFrame:
    """Clean panel: incomplete columns and the latest days dropped, sentinels replaced by means,
    calendar columns and total evapotranspiration added.

    The columns of the series itself (keys, time, tie) stay whatever they hold.  Finding the incomplete columns, the
    latest days and the means are three narrow jobs over the raw table; the result then reads it for its rows.
    """
    lowered = lower_names(raw)
    day = lowered.withColumn(series.time, F.to_date(series.time))
    own = [*series.keys, series.time, *series.tie]
    complete = nan_free(drop_listed(drop_null_columns(day, max_null_fraction, own), [c for c in INCOMPLETE_COLUMNS if c not in own]))
    measured = numeric_columns(complete, exclude=own)
    # cutoff and means are a row a series each: both are known before the wide rows are read for the result
    cutoff = written(latest_cutoff(complete, series, latest), "cutoff")
    dated_rows = add_series_stats(complete, cutoff, list(series.keys)) if series.keys else complete.withColumn("__cutoff", cutoff.scalar())
    facts = dated_rows.groupBy(*series.keys).agg(
        F.first("__cutoff").alias("__cutoff"), *usual_means(measured, sentinels, before_cutoff(series.time))
    )
    joined = attach(complete, written(facts, "means"), series)
    kept = joined.where(before_cutoff(series.time)).select(*filled(complete.columns, measured, sentinels))
    dated = drop_listed(add_calendar(kept, series.time), ZERO_COLUMNS)
    return sum_column(dated, "et_total", ["evland", "evptrns"])
