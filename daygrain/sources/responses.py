"""Landed API responses: JSON documents ``properties.parameter.{NAME}.{yyyymmdd} = value``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.constants import DEFAULT_START, LATE_PARAMETERS, LATE_START, REQUEST_SIZE
from daygrain.functions.calendar import parse_day
from daygrain.operators.blocks import attach, with_row_index
from daygrain.series import Series

BODY_SCHEMA = "properties struct<parameter: map<string, map<string, double>>>"


def parameter_map(body: str) -> Column:
    return F.from_json(F.col(body), BODY_SCHEMA)["properties"]["parameter"]


def response_rows(responses: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Long rows (``keep``..., param, date, value); keys that are no date give a null date."""
    return (
        responses.select(*keep, F.explode(parameter_map(body)).alias("param", "points"))
        .select(*keep, "param", F.explode("points").alias("day", "value"))
        .select(*keep, "param", parse_day("day").alias("date"), "value")
    )


def latest_batch(rows: DataFrame, series: Series, batch: str = "batch", param: str = "param") -> DataFrame:
    """A parameter that several batches carry keeps only its last batch, as a whole."""
    group = [*series.keys, param]
    newest = rows.groupBy(*group).agg(F.max(batch).alias("__newest"))
    return attach(rows, newest, series, group).where(F.col(batch) == F.col("__newest")).drop("__newest")


def align_parameters(rows: DataFrame, series: Series, params: Sequence[str], value: str = "value") -> DataFrame:
    """One column per parameter, aligned on the date: a single shuffle in place of N outer joins."""
    return (
        rows.groupBy(*series.keys, series.time)
        .pivot("param", list(params))
        .agg(F.first(value, ignorenulls=True))
    )


def request_plan(
    catalogue: DataFrame,
    order: str,
    param: str = "parameter",
    size: int = REQUEST_SIZE,
    late: Sequence[str] | None = LATE_PARAMETERS,
    is_late: Column | None = None,
    span: float = 10_000,
) -> DataFrame:
    """Chunks of ``size`` parameters in file order and the start date each chunk asks for.

    A chunk with any late parameter starts late as a whole.
    """
    late_flag = is_late if is_late is not None else F.col(param).isin(*late)
    marked = catalogue.select(order, F.col(param).alias("parameter"), late_flag.alias("late"))
    numbered = with_row_index(marked, Series(time=order, span=span))
    return (
        numbered.groupBy((F.floor(F.col("row_idx") / size) + 1).alias("batch"))
        .agg(
            F.count(F.lit(1)).alias("n_params"),
            F.sort_array(F.collect_list(F.struct("row_idx", "parameter"))).alias("members"),
            F.max(F.col("late").cast("int")).alias("has_late"),
        )
        .select(
            "batch",
            "n_params",
            F.array_join(F.col("members.parameter"), ",").alias("parameters"),
            F.when(F.col("has_late") == 1, LATE_START).otherwise(DEFAULT_START).alias("start_date"),
        )
    )


def audit_responses(
    responses: DataFrame, param: str = "parameter", status: str = "status_code", body: str = "body"
) -> DataFrame:
    """One row per requested parameter: did a usable series come back, and if not why."""
    points = F.coalesce(F.size(parameter_map(body)[F.col(param)]), F.lit(0))
    failed = F.col(status) != 200
    return responses.select(
        F.col(param).alias("parameter"),
        F.col(status).alias("status_code"),
        F.when(failed, False).otherwise(points > 0).alias("ok"),
        F.when(failed, F.concat(F.lit("HTTP "), F.col(status).cast("string")))
        .when(points > 0, "OK")
        .otherwise("No data returned")
        .alias("message"),
    )


def audit_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("ok", "message").agg(F.count(F.lit(1)).alias("n"))
