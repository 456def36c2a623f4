"""Arithmetic with the floating-point conventions of array libraries, and small row functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain.constants import COMFORT, SENTINELS


def float_divide(top: Column, bottom: Column) -> Column:
    """Division that gives infinity for x/0 and missing (null) for 0/0, instead of an error."""
    infinity = F.lit(float("inf"))
    return (
        F.when(bottom != 0, top / bottom)
        .when(bottom.isNull(), F.lit(None).cast("double"))
        .when(top > 0, infinity)
        .when(top < 0, -infinity)
    )


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def nan_free(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` with NaN as null in its (listed) floating columns; other columns are left alone."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = floating if columns is None else [c for c in floating if c in set(columns)]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in chosen}) if chosen else df


def is_missing(value: Column, floating: bool) -> Column:
    return value.isNull() | F.isnan(value) if floating else value.isNull()


def is_sentinel(value: Column, sentinels: Sequence[float] = SENTINELS) -> Column:
    """True for a sentinel, false for anything else including null."""
    return F.coalesce(value.cast("double").isin(*sentinels), F.lit(False))


def any_sentinel(columns: Sequence[str], sentinels: Sequence[float] = SENTINELS) -> Column:
    return reduce(lambda a, b: a | b, [is_sentinel(F.col(c), sentinels) for c in columns])


def above_zero(value: Column) -> Column:
    """max(value, 0), missing stays missing."""
    return F.when(value > 0, value).when(value.isNotNull(), F.lit(0.0))


def heating_degrees(temperature: Column, comfort: float = COMFORT) -> Column:
    return above_zero(F.lit(comfort) - temperature)


def cooling_degrees(temperature: Column, comfort: float = COMFORT) -> Column:
    return above_zero(temperature - F.lit(comfort))


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown comparison counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def temperature_gradients() -> dict[str, Column]:
    c = F.col
    return {
        "temp_gradient_surface": c("t2m") - c("ts"),
        "temp_gradient_soil": c("tsoil1") - c("tsoil4"),
        "temp_gradient_altitude": c("t10m") - c("t2m"),
        "soil_temp_gradient_shallow": c("tsoil1") - c("tsoil2"),
        "soil_temp_gradient_deep": c("tsoil2") - c("tsoil4"),
    }


def weather_interactions() -> dict[str, Column]:
    c = F.col
    return {
        "wind_chill_factor": c("t2m") - c("v10m") * 0.1,
        "heat_index_simple": c("t2m") + c("rhoa") * 0.01,
        "temp_humidity_ratio": float_divide(c("t2m"), c("rhoa") + 1),
        "evaporation_potential": c("t2m") * c("v10m") * 0.01,
        "soil_temp_moisture": c("tsoil1") * c("gwettop"),
        "surface_efficiency": float_divide(c("ts"), c("evptrns") + 0.1),
    }
