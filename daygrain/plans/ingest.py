"""Landed responses to a raw wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daygrain.series import Series
from daygrain.sources.responses import align_parameters, latest_batch, response_rows
from daygrain.sources.tables import replace_table


def ingest_responses(
    responses: DataFrame, series: Series, params: Sequence[str], body: str = "body", batch: str = "batch"
) -> DataFrame:
    """One row per (series, date), one column per parameter, from JSON responses of several batches."""
    rows = response_rows(responses, body, [*series.keys, batch])
    return align_parameters(latest_batch(rows, series, batch), series, params)


def load_raw(responses: DataFrame, series: Series, params: Sequence[str], table: str) -> DataFrame:
    return replace_table(ingest_responses(responses, series, params), table)
