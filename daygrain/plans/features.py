"""Feature tables: the temperature feature store and the rain features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain.constants import (
    RAIN_BASE, RAIN_LAGS, RAIN_ROLLING, ROLLING_WINDOWS, TEMPERATURE_BASE, TEMPERATURE_LAGS, TEMPERATURE_ROLLING,
)
from daygrain.functions.calendar import frequency_encodings, seasonal_encodings
from daygrain.functions.numeric import (
    cooling_degrees, flag, heating_degrees, nan_to_null, temperature_gradients, weather_interactions,
)
from daygrain.operators.blocks import (
    BLOCK, HOME, add_series_stats, as_targets, block_window, lookup, only_home, rows_before, runs_before, spread,
    with_block,
)
from daygrain.operators.stats import exact_quantiles
from daygrain.operators.windows import (
    Naming, acceleration, difference, lag_block, over_recent, past, past_block,
    past_name, rolling_block, volatility, week_statistics,
)
from daygrain.series import Series
from daygrain.session import written
from daygrain.sources.tables import require_columns

# longest look back of the second stage, in rows: the 14-row mean
SECOND_STAGE_ROWS = 13
DERIVED_LAGS = (1, 2, 3)
DERIVED = ("t2m_daily_change", "t2m_volatility_3d", "t2m_anomaly", "temp_gradient_surface", "wind_chill_factor")
NEEDED = ("t2m", "t10m", "ts", "tsurf", "tsoil1", "tsoil2", "tsoil4", "v10m", "rhoa", "gwettop", "evptrns", "month")


def base_frame(df: DataFrame, series: Series, base: Sequence[str], carry: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keys, time, the base columns that exist, carried columns and the day of year; NaN becomes null."""
    present = [c for c in base if c in df.columns]
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    wanted = dict.fromkeys([*series.keys, series.time, *series.tie, *present, *carry])
    rows = df.select(*[nan_to_null(F.col(c)).alias(c) if c in floating else F.col(c) for c in wanted])
    return rows.withColumn("dayofyear", F.dayofyear(series.time)), present


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def _first_stage(
    lagged: Sequence[str], rolled: Sequence[str], lags: Sequence[int], windows: Sequence[int], named: Naming = past_name
) -> list[Column]:
    seasonal = seasonal_encodings(F.col("month"), F.col("dayofyear"))
    return [
        *[c.alias(name) for name, c in seasonal.items()],
        *[past(c, k, named).alias(f"{c}_lag{k}") for c in lagged for k in lags],
        *rolling_block(rolled, windows, named),
    ]


def _depth(lagged: Sequence[str], rolled: Sequence[str], lags: Sequence[int], windows: Sequence[int]) -> dict[str, int]:
    """How many rows back each base column is needed."""
    rolls = max(windows) - 1
    return {c: max(max(lags), rolls if c in rolled else 0) for c in lagged}


def rain_features(
    df: DataFrame, series: Series, carry: Sequence[str] = (), base: Sequence[str] = RAIN_BASE,
    lags: Sequence[int] = RAIN_LAGS, windows: Sequence[int] = ROLLING_WINDOWS, rolling: Sequence[str] = RAIN_ROLLING,
) -> DataFrame:
    """Base columns, seasonal encodings, sparse lags and rolling statistics; incomplete rows dropped."""
    rows, present = base_frame(df, series, base, carry)
    require_columns(rows, ["month"])
    lagged = [c for c in present if c != "month"]
    rolled = [c for c in rolling if c in present]
    built = over_recent(
        rows, series, _depth(lagged, rolled, lags, windows), _first_stage(lagged, rolled, lags, windows)
    )
    return built.na.drop(subset=[c for c in built.columns if c not in series.keys])


# how many rows back the second stage needs each column, counted in surviving rows
SECOND_STAGE_DEPTH = {"t2m": SECOND_STAGE_ROWS, "t10m": 2, "ts": 2, "tsurf": 2}


def raw_name(column: str, k: int) -> str:
    """Lags over all rows, beside the lags over surviving rows that :func:`past_name` names."""
    return f"__raw{k}_{column}"


def _derived() -> dict[str, Column]:
    """Second-stage columns from base columns, their last values and the attached statistics."""
    t2m = F.col("t2m")
    month_mean = F.col("__month_mean")
    return {
        "t2m_volatility_3d": volatility("t2m", 3),
        "t2m_volatility_7d": volatility("t2m", 7),
        "t2m_daily_change": difference("t2m"),
        "t2m_acceleration": acceleration("t2m"),
        "t10m_volatility_3d": volatility("t10m", 3),
        "ts_volatility_3d": volatility("ts", 3),
        "tsurf_volatility_3d": volatility("tsurf", 3),
        "hdd": heating_degrees(t2m),
        "cdd": cooling_degrees(t2m),
        "t2m_monthly_avg": month_mean,
        "t2m_anomaly": t2m - month_mean,
        "t2m_seasonal_trend": F.col("__month_std"),
        "t2m_vs_seasonal_avg": t2m - month_mean,
        "t2m_is_extreme_hot": flag(t2m > F.col("__p95")),
        "t2m_is_extreme_cold": flag(t2m < F.col("__p05")),
        **temperature_gradients(),
        **weather_interactions(),
    }


def temperature_features(
    df: DataFrame, series: Series, carry: Sequence[str] = (), base: Sequence[str] = TEMPERATURE_BASE,
    lags: Sequence[int] = TEMPERATURE_LAGS, windows: Sequence[int] = ROLLING_WINDOWS,
    rolling: Sequence[str] = TEMPERATURE_ROLLING, fit_until: str | None = None,
) -> DataFrame:
    """The temperature feature store: 392 columns when all base columns are present.

    Stage one adds seasonal, lag and rolling columns and drops incomplete rows.  Stage two
    works on the rows that survive: its windows and its statistics (monthly mean and deviation,
    5 % and 95 % quantiles) see survivors only.

    Which rows survive, which rows each block must borrow for both stages, and the statistics
    are found on a few narrow columns, in jobs that run when this function is called.  The
    returned plan then reads the wide rows once, joins the small table of blocks, and takes one
    shuffle, whose order both stages share.

    ``carry`` names further columns (forecast targets) that must be complete too.  ``fit_until``
    limits the statistics to rows up to that date, so a test period does not leak into them.
    """
    rows, present = base_frame(df, series, base, carry)
    require_columns(rows, NEEDED)
    lagged = [c for c in present if c != "month"]
    rolled = [c for c in rolling if c in present]
    reach = max([*lags, *[n - 1 for n in windows]])
    keys, time = list(series.keys), series.time
    rows = rows.select(
        "*",
        _all_known([time, *present, *carry]).alias("__row_ok"),
        _all_known(lagged).alias("__lag_ok"),
        _all_known(rolled).alias("__roll_ok"),
    )

    flags = {"__lag_ok": max(lags), "__roll_ok": max(windows) - 1}
    needed_flags = [
        *[past("__lag_ok", k, raw_name) for k in lags], *[past("__roll_ok", k, raw_name) for k in range(max(windows))],
    ]
    survives = reduce(lambda a, b: a & F.coalesce(b, F.lit(False)), needed_flags, F.col("__row_ok"))

    # narrow pass: survivors, their statistics, and what each block has to borrow; each table
    # is used several times, so it is written once
    narrow = written(
        rows.select(*keys, time, *series.tie, "month", "t2m", "__row_ok", "__lag_ok", "__roll_ok"), "narrow"
    )
    first_bounds = rows_before(narrow, series, reach)
    w = block_window(series)
    survivors = written(
        only_home(
            spread(narrow, series, as_targets([first_bounds], narrow, series)).select(
                "*", *past_block(flags, w, raw_name),
                F.lag(time, reach).over(w).alias("__reach"),
                F.array_sort(F.collect_set(HOME).over(w.rowsBetween(-reach, 0))).alias("__sources"),
            ).where(survives)
        ).select(*keys, time, "month", "t2m", "__reach", "__sources"),
        "survivors",
    )
    second_bounds = runs_before(survivors, series, SECOND_STAGE_ROWS, "__reach", "__sources")
    fitted = survivors if fit_until is None else survivors.where(F.col(time) <= F.lit(fit_until).cast("date"))
    monthly = fitted.groupBy(*keys, "month").agg(
        F.struct(F.avg("t2m").alias("mean"), F.stddev_samp("t2m").alias("std")).alias("s")
    ).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("month", "s"))).alias("__monthly"))
    extremes = exact_quantiles(fitted, series, "t2m", {"__p05": 0.05, "__p95": 0.95})
    per_block = with_block(narrow, series).select(*keys, BLOCK).distinct()
    per_block = add_series_stats(add_series_stats(per_block, monthly, keys), extremes, keys)
    targets = as_targets([first_bounds, second_bounds], narrow, series)
    per_block = written(lookup(per_block, targets, [*keys, BLOCK]), "per_block")

    # wide pass: all windows work on base columns and lags; the other columns are projected last,
    # for the rows of the block itself only
    own_month = F.col("__monthly")[F.col("month")]
    # of the rows a block borrows, those its second stage looks back to; the others serve the lags of these
    wanted = F.exists("targets", lambda t: (t["target"] == F.col(BLOCK)) & (t["hi"] == F.col(time)))
    own = F.col(HOME).eqNullSafe(F.col(BLOCK))
    wide = spread(rows, series, per_block, ["__monthly", "__p05", "__p95", "targets"]).select(
        "*", own_month["mean"].alias("__month_mean"), own_month["std"].alias("__month_std"),
        (own | F.coalesce(wanted, F.lit(False))).alias("__wanted"),
    ).drop("__monthly", "targets")
    lagging = wide.select("*", *past_block({**_depth(lagged, rolled, lags, windows), **flags}, w, raw_name))
    kept = lagging.where(survives & F.col("__wanted"))
    derived = _derived()
    early = [derived[c].alias(c) for c in DERIVED]
    windowed = kept.select("*", *past_block(SECOND_STAGE_DEPTH, w)).select("*", *early)
    finished = only_home(windowed.select("*", *lag_block(DERIVED, DERIVED_LAGS, w)))
    visible = [c for c in rows.columns if not c.startswith("__")]
    first = _first_stage(lagged, rolled, lags, windows, raw_name)
    second = [
        *[F.col(name) if name in DERIVED else c.alias(name) for name, c in derived.items()],
        *week_statistics("t2m"),
        *[c.alias(name) for name, c in frequency_encodings(F.col("month"), F.col("dayofyear")).items()],
        *[F.col(f"{c}_lag{k}") for c in DERIVED for k in DERIVED_LAGS],
    ]
    table = finished.select(*visible, *first, *second)
    return table.na.drop(subset=table.columns[len(visible) + len(first):])


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("date", "day", "week", "weekday")) -> list[str]:
    """Numeric columns that may be used as features: no targets, no listed columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return [c for c in numeric if c not in exclude and not c.endswith("_forecast")]
