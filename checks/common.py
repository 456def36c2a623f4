"""Shared inputs of the checks and the way their results are written down.

The driver tables hold no weather data, so a daily panel is derived from ``lineitem``: one row
per (l_returnflag, l_linestatus, day).  Every value comes from integer sums, so both engines
start from bit-identical numbers; the expressions below are plain SQL that both understand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain import Series

KEYS = ("l_returnflag", "l_linestatus")
PANEL_SERIES = Series(KEYS, "date")
DAILY_SERIES = Series((), "date", span=256)

AGGREGATES = {
    "n": "CAST(count(*) AS DOUBLE)",
    "q": "CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE)",
    "c": "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)",
    "d": "CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE)",
    "x": "CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE)",
    "z": "CAST(sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS DOUBLE)",
    "q_max": "max(l_quantity)",
    "q_min": "min(l_quantity)",
    "c_max": "max(l_extendedprice)",
    "c_min": "min(l_extendedprice)",
}

# measurement name -> expression over the aggregates
MEASURES = {
    "t2m": "q / n", "t2m_max": "q_max", "t2m_min": "q_min", "t2m_range": "q_max - q_min",
    "t10m": "(q + d) / n", "t10m_max": "q_max + d / n", "t10m_min": "q_min - d / n",
    "t10m_range": "q_max - q_min + 2 * d / n",
    "ts": "c / (n * 100000)", "ts_max": "c_max / 1000", "ts_min": "c_min / 1000", "ts_range": "(c_max - c_min) / 1000",
    "tsurf": "(c + 1000 * x) / (n * 100000)",
    "tsoil1": "(2 * q + d) / (2 * n)", "tsoil2": "(3 * q + d + x) / (3 * n)",
    "tsoil3": "(q + x) / n", "tsoil4": "(q + 2 * d + x) / (2 * n)",
    "v2m": "(d - x) / n", "v10m": "d / n - 5", "v50m": "x / n - 4",
    "rhoa": "x / n", "t2mwet": "(q - d) / n",
    "gwettop": "d / (100 * n)", "gwetroot": "x / (100 * n)", "gwetprof": "(d + x) / (200 * n)",
    "evland": "d / n", "evptrns": "x / n",
    "z0m": "n / 10", "to3": "250 + (d + x) / 10",
    "prectotcorr": "z", "ws10m": "n",
    "tqv": "(q + x) / (2 * n)", "qv2m": "(d + x) / n", "qv10m": "(2 * d + x) / n", "rh2m": "50 + d / n",
    "t2mdew": "q / n - x / n", "ps": "1000 + c / (n * 100000)", "slp": "1000 + (c + d) / (n * 100000)",
    "u10m": "(x - d) / n", "wd10m": "10 * d / n",
}
SMALL = ("t2m", "t2m_min", "t2m_max", "t2m_range", "ts", "evland", "evptrns", "gwettop", "prectotcorr", "ws10m")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def daily_panel(spark: SparkSession, sf: str, measures: Sequence[str] = SMALL, keys: Sequence[str] = KEYS) -> DataFrame:
    grouped = table(spark, sf, "lineitem").groupBy(*keys, F.to_date("l_shipdate").alias("date"))
    sums = grouped.agg(*[F.expr(e).alias(a) for a, e in AGGREGATES.items()])
    return sums.select(*keys, "date", *[F.expr(MEASURES[m]).alias(m) for m in measures])


def panel_sql(measures: Sequence[str] = SMALL, keys: Sequence[str] = KEYS) -> str:
    listed = "".join(f"{k}, " for k in keys)
    sums = ", ".join(f"{e} AS {a}" for a, e in AGGREGATES.items())
    shown = ", ".join(f"{MEASURES[m]} AS {m}" for m in measures)
    return (
        f"SELECT {listed}date, {shown} FROM (SELECT {listed}CAST(l_shipdate AS DATE) AS date, {sums} "
        f"FROM lineitem GROUP BY {listed}CAST(l_shipdate AS DATE))"
    )


def with_panel(body: str, measures: Sequence[str] = SMALL, keys: Sequence[str] = KEYS, **more: str) -> str:
    """``WITH panel AS (...), more... body``."""
    ctes = "".join(f", {name} AS ({sql})" for name, sql in more.items())
    return f"WITH panel AS ({panel_sql(measures, keys)}){ctes} {body}"


# Both engines compute the same doubles up to the last bits.  Rounding at exactly one half would
# let such a bit decide values that end in 5, so the checks round at a point no value lies on.
HALF = 0.4999137

WIN = f"WINDOW w AS (PARTITION BY {', '.join(KEYS)} ORDER BY date)"


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, dates and timestamps as text, booleans as 0/1."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.floor(c * F.lit(10.0**digits) + F.lit(HALF)) / F.lit(10.0**digits)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, digits: int = 6) -> str:
    """The same rounding as :func:`shown` in SQL."""
    return f"floor(({expr}) * 1e{digits} + {HALF * 10}e-1) / 1e{digits}"


def cols(names: Sequence[str], digits: int = 6) -> str:
    """SQL for the result columns: ``name:f`` double, ``name:d`` date, ``name`` as it is."""
    out = []
    for item in names:
        name, _, kind = item.partition(":")
        if kind == "f":
            out.append(f"{r(name, digits)} AS {name}")
        elif kind == "d":
            out.append(f"strftime({name}, '%Y-%m-%d') AS {name}")
        elif kind == "b":
            out.append(f"CAST({name} AS INTEGER) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query and, if its result can be written in SQL, that SQL."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
