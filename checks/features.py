"""Whole feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import KEYS, PANEL_SERIES, DAILY_SERIES, MEASURES, check, daily_panel, panel_sql, r, shown
from daygrain import Series
from daygrain import constants as K
from daygrain.operators.cleaning import sum_column
from daygrain.operators.windows import add_targets
from daygrain.plans.features import rain_features, temperature_features
from daygrain.functions.calendar import calendar_columns

ALL = tuple(MEASURES)


def clean_panel(spark, sf, keys=KEYS):
    df = sum_column(daily_panel(spark, sf, ALL, keys), "et_total", ["evland", "evptrns"])
    calendar = calendar_columns("date")
    return df.select("*", *[c.alias(n) for n, c in calendar.items()])


SEASON = "CASE WHEN month(date) IN (12, 1, 2) THEN 0 WHEN month(date) IN (3, 4, 5) THEN 1 ELSE 2 END"


def clean_sql(keys=KEYS):
    return (
        f"SELECT *, evland + evptrns AS et_total, year(date) AS year, month(date) AS month, day(date) AS day, "
        f"week(date) AS week, isodow(date) - 1 AS weekday, {SEASON} AS season_num FROM ({panel_sql(ALL, keys)})"
    )


def _div(a, b):
    return f"({a}) / ({b})"


def _lag(c, k):
    return f"lag({c}, {k}) OVER w"


def _roll(c, n, fn):
    frame = f"(PARTITION BY @K ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) OVER {frame} = {n} THEN {fn} OVER {frame} END"


def seasonal_sql():
    return {
        "month_sin": "sin(2 * pi() * month / 12)", "month_cos": "cos(2 * pi() * month / 12)",
        "doy_sin": "sin(2 * pi() * dayofyear / 365)", "doy_cos": "cos(2 * pi() * dayofyear / 365)",
    }


def stage_one_sql(base, rolled, lags, windows):
    out = dict(seasonal_sql())
    for c in base:
        if c != "month":
            for k in lags:
                out[f"{c}_lag{k}"] = _lag(c, k)
    for c in rolled:
        for n in windows:
            out[f"{c}_roll{n}_mean"] = _roll(c, n, f"avg({c})")
            out[f"{c}_roll{n}_std"] = _roll(c, n, f"stddev_samp({c})")
    return out


def stage_two_sql():
    def vol(c, n):
        return _div(_roll(c, n, f"stddev_samp({c})"), _roll(c, n, f"avg({c})"))

    hi, lo = _roll("t2m", 7, "max(t2m)"), _roll("t2m", 7, "min(t2m)")
    p25, p75 = _roll("t2m", 7, "quantile_cont(t2m, 0.25)"), _roll("t2m", 7, "quantile_cont(t2m, 0.75)")
    return {
        "t2m_volatility_3d": vol("t2m", 3), "t2m_volatility_7d": vol("t2m", 7),
        "t2m_daily_change": f"t2m - {_lag('t2m', 1)}",
        "t2m_acceleration": f"(t2m - {_lag('t2m', 1)}) - ({_lag('t2m', 1)} - {_lag('t2m', 2)})",
        "t10m_volatility_3d": vol("t10m", 3), "ts_volatility_3d": vol("ts", 3), "tsurf_volatility_3d": vol("tsurf", 3),
        "hdd": "CASE WHEN 26 - t2m > 0 THEN 26 - t2m ELSE 0 END", "cdd": "CASE WHEN t2m - 26 > 0 THEN t2m - 26 ELSE 0 END",
        "t2m_monthly_avg": "avg_m", "t2m_anomaly": "t2m - avg_m", "t2m_seasonal_trend": "std_m",
        "t2m_vs_seasonal_avg": "t2m - avg_m",
        "t2m_is_extreme_hot": "CAST(t2m > p95 AS INTEGER)", "t2m_is_extreme_cold": "CAST(t2m < p05 AS INTEGER)",
        "temp_gradient_surface": "t2m - ts", "temp_gradient_soil": "tsoil1 - tsoil4", "temp_gradient_altitude": "t10m - t2m",
        "soil_temp_gradient_shallow": "tsoil1 - tsoil2", "soil_temp_gradient_deep": "tsoil2 - tsoil4",
        "wind_chill_factor": "t2m - v10m * 0.1", "heat_index_simple": "t2m + rhoa * 0.01",
        "temp_humidity_ratio": "t2m / (rhoa + 1)", "evaporation_potential": "t2m * v10m * 0.01",
        "soil_temp_moisture": "tsoil1 * gwettop", "surface_efficiency": "ts / (evptrns + 0.1)",
        "t2m_rolling_p25": p25, "t2m_rolling_p75": p75, "t2m_rolling_iqr": f"({p75}) - ({p25})",
        "t2m_position_in_week": f"t2m / (({hi}) + 0.001)",
        "t2m_relative_to_recent_max": f"t2m - ({hi})", "t2m_relative_to_recent_min": f"t2m - ({lo})",
        "t2m_momentum_3d": f"t2m - {_lag('t2m', 3)}", "t2m_momentum_7d": f"t2m - {_lag('t2m', 7)}",
        "t2m_trend_strength": f"({_roll('t2m', 7, 'avg(t2m)')}) - ({_roll('t2m', 14, 'avg(t2m)')})",
        "week_sin": "sin(2 * pi() * dayofyear / 7)", "week_cos": "cos(2 * pi() * dayofyear / 7)",
        "quarter_sin": "sin(2 * pi() * (month - 1) / 3)", "quarter_cos": "cos(2 * pi() * (month - 1) / 3)",
        "half_year_sin": "sin(2 * pi() * (month - 1) / 6)", "half_year_cos": "cos(2 * pi() * (month - 1) / 6)",
        "month_progress": "(dayofyear % 30) / 30.0",
    }


DERIVED = ("t2m_daily_change", "t2m_volatility_3d", "t2m_anomaly", "temp_gradient_surface", "wind_chill_factor")
INTEGERS = {"month", "dayofyear", "season_num", "t2m_is_extreme_hot", "t2m_is_extreme_cold"}


def _final(names, keys, digits):
    out = list(keys) + ["strftime(date, '%Y-%m-%d') AS date"]
    for c in names:
        whole = c in INTEGERS or c.startswith("season_num_lag")
        out.append(f"CAST({c} AS INTEGER) AS {c}" if whole else f"{r(c, digits)} AS {c}")
    return ", ".join(out)


def temperature_sql(keys=KEYS, digits=5, source=None):
    base = list(K.TEMPERATURE_BASE)
    one = stage_one_sql(base, K.TEMPERATURE_ROLLING, K.TEMPERATURE_LAGS, K.ROLLING_WINDOWS)
    two = stage_two_sql()
    three = {f"{c}_lag{k}": _lag(c, k) for c in DERIVED for k in (1, 2, 3)}
    by = ", ".join(keys) or "1"
    k = "".join(f"{c}, " for c in keys)
    listed = lambda d: ", ".join(f"{e} AS {n}" for n, e in d.items())
    known = lambda names: " AND ".join(f"{n} IS NOT NULL" for n in names)
    same = lambda a: " AND ".join([f"s1.{c} IS NOT DISTINCT FROM {a}.{c}" for c in keys] or ["true"])
    win = f"WINDOW w AS (PARTITION BY {by} ORDER BY date)"
    sql = f"""
    WITH base AS (SELECT {k}date, {', '.join(base)}, dayofyear(date) AS dayofyear FROM ({source or clean_sql(keys)})),
    s1 AS (SELECT * FROM (SELECT *, {listed(one)} FROM base {win}) WHERE {known([*base, *one])}),
    m AS (SELECT {k}month AS mm, avg(t2m) AS avg_m, stddev_samp(t2m) AS std_m FROM s1 GROUP BY {k}month),
    p AS (SELECT {k}quantile_cont(t2m, 0.05) AS p05, quantile_cont(t2m, 0.95) AS p95 FROM s1 {'GROUP BY ' + by if keys else ''}),
    s2 AS (SELECT s1.*, m.avg_m, m.std_m, p.p05, p.p95 FROM s1 JOIN m ON s1.month = m.mm AND {same('m')} JOIN p ON {same('p')}),
    s3 AS (SELECT *, {listed(two)} FROM s2 {win}),
    s4 AS (SELECT *, {listed(three)} FROM s3 {win})
    SELECT {_final([*base, 'dayofyear', *one, *two, *three], keys, digits)} FROM s4 WHERE {known([*two, *three])}
    """
    return sql.replace("@K", by)


def carried_sql(targets, keys=KEYS):
    """Which rows the store keeps when the forecast targets of t2m must be known as well."""
    by = ", ".join(keys)
    leads = ", ".join(f"lead(t2m, {h}) OVER t AS {name}" for h, name in enumerate(targets, start=1))
    source = f"SELECT *, {leads} FROM ({clean_sql(keys)}) WINDOW t AS (PARTITION BY {by} ORDER BY date)"
    one = stage_one_sql(K.TEMPERATURE_BASE, K.TEMPERATURE_ROLLING, K.TEMPERATURE_LAGS, K.ROLLING_WINDOWS)
    two = stage_two_sql()
    three = {f"{c}_lag{k}": _lag(c, k) for c in DERIVED for k in (1, 2, 3)}
    listed = lambda d: ", ".join(f"{e} AS {n}" for n, e in d.items())
    known = lambda names: " AND ".join(f"{n} IS NOT NULL" for n in names)
    win = f"WINDOW w AS (PARTITION BY {by} ORDER BY date)"
    same = " AND ".join(f"s1.{c} = m.{c}" for c in keys)
    # quantiles are never null here, so any value stands for them
    sql = f"""
    WITH base AS (SELECT {by}, date, {', '.join(K.TEMPERATURE_BASE)}, {', '.join(targets)}, dayofyear(date) AS dayofyear FROM ({source})),
    s1 AS (SELECT * FROM (SELECT *, {listed(one)} FROM base {win}) WHERE {known([*K.TEMPERATURE_BASE, *targets, *one])}),
    m AS (SELECT {by}, month AS mm, avg(t2m) AS avg_m, stddev_samp(t2m) AS std_m FROM s1 GROUP BY {by}, month),
    s2 AS (SELECT s1.*, m.avg_m, m.std_m, 0 AS p05, 0 AS p95 FROM s1 JOIN m ON s1.month = m.mm AND {same}),
    s3 AS (SELECT *, {listed(two)} FROM s2 {win}), s4 AS (SELECT *, {listed(three)} FROM s3 {win})
    SELECT {by}, date, t2m FROM s4 WHERE {known([*two, *three])}
    """
    return sql.replace("@K", by)


def rain_sql(keys=KEYS, digits=6):
    base = list(K.RAIN_BASE)
    targets = {f"t2m_d{h}_forecast": f"lead(t2m, {h}) OVER w" for h in range(1, 8)}
    one = stage_one_sql(base, K.RAIN_ROLLING, K.RAIN_LAGS, K.ROLLING_WINDOWS)
    by, k = ", ".join(keys), "".join(f"{c}, " for c in keys)
    listed = lambda d: ", ".join(f"{e} AS {n}" for n, e in d.items())
    win = f"WINDOW w AS (PARTITION BY {by} ORDER BY date)"
    names = [*base, *targets, "dayofyear", *one]
    sql = f"""
    WITH base AS (SELECT {k}date, {', '.join(base)}, dayofyear(date) AS dayofyear, {listed(targets)} FROM ({clean_sql(keys)}) {win}),
    s1 AS (SELECT *, {listed(one)} FROM base {win})
    SELECT {_final(names, keys, digits)} FROM s1 WHERE {' AND '.join(f'{n} IS NOT NULL' for n in names)}
    """
    return sql.replace("@K", by)


@check("c3_temperature_features", temperature_sql())
def c3(spark, sf):
    return shown(temperature_features(clean_panel(spark, sf), PANEL_SERIES), 5)


@check("c3_temperature_features_one_series", temperature_sql(()))
def c3_single(spark, sf):
    return shown(temperature_features(clean_panel(spark, sf, ()), DAILY_SERIES), 5)


# a sensor that is silent for two and a half years, and blocks much shorter than that
SILENT = "date BETWEEN DATE '1994-01-01' AND DATE '1996-06-30'"


@check(
    "c3_temperature_features_outage",
    temperature_sql((), source=f"SELECT * REPLACE (CASE WHEN NOT {SILENT} THEN tsoil1 END AS tsoil1) FROM ({clean_sql(())})"),
)
def c3_outage(spark, sf):
    clean = clean_panel(spark, sf, ()).withColumn("tsoil1", F.when(F.expr(f"NOT {SILENT}"), F.col("tsoil1")))
    return shown(temperature_features(clean, Series((), "date", span=64)), 5)


@check("c4_rain_features", rain_sql())
def c4(spark, sf):
    clean = add_targets(clean_panel(spark, sf), PANEL_SERIES, {"t2m": "t2m"})
    carry = [f"t2m_d{h}_forecast" for h in range(1, 8)]
    return shown(rain_features(clean, PANEL_SERIES, carry))
