"""Row windows, ordered access and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import DAILY_SERIES, KEYS, PANEL_SERIES, check, cols, daily_panel, r, shown, table, with_panel
from daygrain.operators import sequences as seq
from daygrain.operators import windows as W
from daygrain.operators.stats import exact_quantiles, with_group_stats
from daygrain.operators.blocks import attach
from daygrain.functions.numeric import flag
from daygrain.series import Series

K = ", ".join(KEYS)
OVER = f"WINDOW w AS (PARTITION BY {K} ORDER BY date)"


def frame(n, by=K, t="date"):
    return f"OVER (PARTITION BY {by} ORDER BY {t} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(fn, c, n, by=K, t="date"):
    f = frame(n, by, t)
    return f"CASE WHEN count({c}) {f} = {n} THEN {fn} {f} END"


def result(named: dict[str, str], measures=("t2m",), tail=OVER):
    shown_cols = ", ".join(f"{r(e)} AS {n}" for n, e in named.items())
    return with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {shown_cols} FROM panel {tail}", measures)


def recent(spark, sf, depth, columns):
    """Key columns, date and columns made from the last values."""
    panel = daily_panel(spark, sf, tuple(depth))
    return shown(W.over_recent(panel, PANEL_SERIES, depth, columns).drop(*depth))


@check("w1_lag_block", result({f"{c}_lag{k}": f"lag({c}, {k}) OVER w" for c in ("t2m", "ts", "gwettop") for k in range(1, 8)}, ("t2m", "ts", "gwettop")))
def w1(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts", "gwettop"))
    return shown(W.add_lags(panel, PANEL_SERIES, ["t2m", "ts", "gwettop"], range(1, 8)).drop("t2m", "ts", "gwettop"))


@check("w2_sparse_lags", result({f"{c}_lag{k}": f"lag({c}, {k}) OVER w" for c in ("t2m_range", "prectotcorr") for k in (1, 3, 7)}, ("t2m_range", "prectotcorr")))
def w2(spark, sf):
    panel = daily_panel(spark, sf, ("t2m_range", "prectotcorr"))
    return shown(W.add_lags(panel, PANEL_SERIES, ["t2m_range", "prectotcorr"], [1, 3, 7]).drop("t2m_range", "prectotcorr"))


@check("w1_lag_event_stream", f"SELECT event_id, {r('lag(value, 1) OVER w')} AS value_lag1, {r('lag(value, 7) OVER w')} AS value_lag7 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)")
def w1_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    series = Series(("event_type",), "ts", ("event_id",), span=0.5)
    return shown(W.add_lags(events, series, ["value"], [1, 7]).select("event_id", "value_lag1", "value_lag7"))


@check("w3_rolling_mean", result({f"m{n}": roll("avg(t2m)", "t2m", n) for n in (3, 7)}, tail=""))
def w3(spark, sf):
    return recent(spark, sf, {"t2m": 6}, [W.rolling_mean("t2m", n).alias(f"m{n}") for n in (3, 7)])


@check("w4_rolling_std", result({f"s{n}": roll("stddev_samp(t2m)", "t2m", n) for n in (3, 7)}, tail=""))
def w4(spark, sf):
    return recent(spark, sf, {"t2m": 6}, [W.rolling_std("t2m", n).alias(f"s{n}") for n in (3, 7)])


@check("w5_rolling_month_and_year", result({f"t2m_roll{n}_{k}": roll(f"{fn}(t2m)", "t2m", n) for n in (30, 365) for k, fn in (("mean", "avg"), ("std", "stddev_samp"))}, tail=""))
def w5_long(spark, sf):
    return shown(W.add_rolling(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, ["t2m"], [30, 365]).drop("t2m"))


ROLLED = ("t2m", "t2m_max", "t2m_min", "ts", "gwettop")


@check(
    "w5_rolling_block",
    result({f"{c}_roll{n}_{k}": roll(f"{fn}({c})", c, n) for c in ROLLED for n in (3, 7) for k, fn in (("mean", "avg"), ("std", "stddev_samp"))}, ROLLED, ""),
)
def w5(spark, sf):
    panel = daily_panel(spark, sf, ROLLED)
    return shown(W.add_rolling(panel, PANEL_SERIES, [*ROLLED, "absent"], [3, 7]).drop(*ROLLED))


P25, P75 = roll("quantile_cont(t2m, 0.25)", "t2m", 7), roll("quantile_cont(t2m, 0.75)", "t2m", 7)


@check("w6_rolling_quantiles", result({"p25": P25, "p75": P75, "iqr": f"({P75}) - ({P25})"}, tail=""))
def w6(spark, sf):
    p25, p75 = W.rolling_quantile("t2m", 7, 0.25), W.rolling_quantile("t2m", 7, 0.75)
    return recent(spark, sf, {"t2m": 6}, [p25.alias("p25"), p75.alias("p75"), (p75 - p25).alias("iqr")])


HI, LO = roll("max(t2m)", "t2m", 7), roll("min(t2m)", "t2m", 7)


@check("w7_position_in_week", result({"position": f"t2m / (({HI}) + 0.001)", "to_max": f"t2m - ({HI})", "to_min": f"t2m - ({LO})"}, tail=""))
def w7(spark, sf):
    value, high, low = F.col("t2m"), W.rolling_max("t2m", 7), W.rolling_min("t2m", 7)
    columns = [(value / (high + 0.001)).alias("position"), (value - high).alias("to_max"), (value - low).alias("to_min")]
    return recent(spark, sf, {"t2m": 6}, columns)


@check("w8_difference", result({"change": "t2m - lag(t2m, 1) OVER w"}))
def w8(spark, sf):
    return recent(spark, sf, {"t2m": 1}, [W.difference("t2m").alias("change")])


@check("w9_acceleration", result({"acceleration": "(t2m - lag(t2m, 1) OVER w) - (lag(t2m, 1) OVER w - lag(t2m, 2) OVER w)"}))
def w9(spark, sf):
    return recent(spark, sf, {"t2m": 2}, [W.acceleration("t2m").alias("acceleration")])


@check("w10_momentum", result({f"momentum_{k}d": f"t2m - lag(t2m, {k}) OVER w" for k in (3, 7)}))
def w10(spark, sf):
    return recent(spark, sf, {"t2m": 7}, [W.difference("t2m", k).alias(f"momentum_{k}d") for k in (3, 7)])


@check("w11_trend_strength", result({"strength": f"({roll('avg(t2m)', 't2m', 7)}) - ({roll('avg(t2m)', 't2m', 14)})"}, tail=""))
def w11(spark, sf):
    return recent(spark, sf, {"t2m": 13}, [W.trend_strength("t2m").alias("strength")])


def vol(c, n):
    return f"({roll(f'stddev_samp({c})', c, n)}) / ({roll(f'avg({c})', c, n)})"


@check("w12_volatility", result({"t2m_3": vol("t2m", 3), "t2m_7": vol("t2m", 7), "ts_3": vol("ts", 3), "tsurf_3": vol("tsurf", 3), "t10m_3": vol("t10m", 3)}, ("t2m", "ts", "tsurf", "t10m"), ""))
def w12(spark, sf):
    pairs = [("t2m", 3), ("t2m", 7), ("ts", 3), ("tsurf", 3), ("t10m", 3)]
    return recent(spark, sf, {"t2m": 6, "ts": 2, "tsurf": 2, "t10m": 2}, [W.volatility(c, n).alias(f"{c}_{n}") for c, n in pairs])


@check(
    "w13_lags_of_derived",
    with_panel(
        f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, "
        + ", ".join(f"{r(f'lag({c}, {k}) OVER w')} AS {c}_lag{k}" for c in ("change", "volatility", "gradient") for k in (1, 2, 3))
        + f" FROM derived {OVER}",
        ("t2m", "ts"),
        derived=f"SELECT *, t2m - lag(t2m, 1) OVER w AS change, {vol('t2m', 3)} AS volatility, t2m - ts AS gradient FROM panel {OVER}",
    ),
)
def w13(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "ts"))
    derived = W.over_recent(panel, PANEL_SERIES, {"t2m": 2}, [
        W.difference("t2m").alias("change"), W.volatility("t2m", 3).alias("volatility"),
        (F.col("t2m") - F.col("ts")).alias("gradient"),
    ])
    return shown(W.add_lags(derived, PANEL_SERIES, ["change", "volatility", "gradient"], [1, 2, 3]).drop(
        "t2m", "ts", "change", "volatility", "gradient"
    ))


TARGET_OF = {"t2m": "t2m", "rain": "prectotcorr", "et": "et_total", "soil": "gwettop", "wind": "ws10m"}


@check(
    "w14_forecast_targets",
    result({f"{p}_d{h}_forecast": f"lead({'evland + evptrns' if c == 'et_total' else c}, {h}) OVER w" for p, c in TARGET_OF.items() for h in range(1, 8)},
           ("t2m", "prectotcorr", "evland", "evptrns", "gwettop", "ws10m")),
)
def w14(spark, sf):
    panel = daily_panel(spark, sf, ("t2m", "prectotcorr", "evland", "evptrns", "gwettop", "ws10m"))
    panel = panel.withColumn("et_total", F.col("evland") + F.col("evptrns"))
    return shown(W.add_targets(panel, PANEL_SERIES).select(*KEYS, "date", *W.target_names()))


@check("w14_forecast_targets_one_series", with_panel(
    "SELECT strftime(date, '%Y-%m-%d') AS date, " + ", ".join(f"{r(f'lead(t2m, {h}) OVER (ORDER BY date)')} AS t2m_d{h}_forecast" for h in range(1, 8)) + " FROM panel",
    ("t2m",), ()))
def w14_single(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",), ())
    return shown(W.add_targets(panel, DAILY_SERIES, {"t2m": "t2m"}).drop("t2m"))


@check("w15_row_position", with_panel(f"SELECT {K}, strftime(date, '%Y-%m-%d') AS date, row_number() OVER w - 1 AS day_index FROM panel {OVER}", ("t2m",)))
def w15(spark, sf):
    return shown(W.add_position(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES).drop("t2m"))


def sequence_sql(lookback, by=K, keys=KEYS):
    listed = "".join(f"{k}, " for k in keys)
    return f"""
    SELECT {listed}strftime(a.date, '%Y-%m-%d') AS date, p.i - (a.i - {lookback}) AS pos, {r('p.t2m')} AS t2m, {r('p.ts')} AS ts, {r('a.y1')} AS y1, {r('a.y7')} AS y7
    FROM idx a JOIN idx p USING ({by}) WHERE p.i BETWEEN a.i - {lookback} AND a.i - 1 AND a.i BETWEEN {lookback} AND a.n - 8
    """


INDEXED = f"""SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY {K}) AS n,
lead(t2m, 1) OVER w AS y1, lead(t2m, 7) OVER w AS y7 FROM panel {OVER}"""


def sequences(spark, sf, lookback):
    panel = W.add_targets(daily_panel(spark, sf, ("t2m", "ts")), PANEL_SERIES, {"t2m": "t2m"})
    return seq.sliding_sequences(panel, PANEL_SERIES, ["t2m", "ts"], ["t2m_d1_forecast", "t2m_d7_forecast"], lookback)


def laid_out(rows):
    return rows.select(*KEYS, "date", "y", F.posexplode("x").alias("pos", "f")).select(
        *KEYS, "date", "pos", F.col("f")[0].alias("t2m"), F.col("f")[1].alias("ts"), F.col("y")[0].alias("y1"), F.col("y")[1].alias("y7")
    )


@check("w16_sequences_of_7", with_panel(sequence_sql(7), ("t2m", "ts"), idx=INDEXED))
def w16(spark, sf):
    return shown(laid_out(sequences(spark, sf, 7)))


@check("w16_sequences_of_30", with_panel(sequence_sql(30), ("t2m", "ts"), idx=INDEXED))
def w16_30(spark, sf):
    return shown(laid_out(sequences(spark, sf, 30)))


@check(
    "w17_latest_sequence",
    with_panel(
        f"""SELECT {K}, i - (n - 7) AS pos, {r('t2m')} AS t2m, {r('ts')} AS ts,
        strftime(max(date) OVER (PARTITION BY {K}), '%Y-%m-%d') AS last_time FROM idx WHERE i >= n - 7""", ("t2m", "ts"), idx=INDEXED),
)
def w17(spark, sf):
    newest = seq.latest_sequence(daily_panel(spark, sf, ("t2m", "ts")), PANEL_SERIES, ["t2m", "ts"], 7)
    return shown(newest.select(*KEYS, "last_time", F.posexplode("x").alias("pos", "f")).select(
        *KEYS, "last_time", "pos", F.col("f")[0].alias("t2m"), F.col("f")[1].alias("ts")
    ))


@check("w18_latest_row", with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f', 'ts:f'])} FROM idx WHERE i = n - 1", ("t2m", "ts"), idx=INDEXED))
def w18(spark, sf):
    return shown(W.latest_row(daily_panel(spark, sf, ("t2m", "ts")), PANEL_SERIES))


@check("w19_last_120_rows", with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f', 'y7:f'])} FROM idx WHERE i >= n - 120", ("t2m",), idx=INDEXED))
def w19(spark, sf):
    panel = W.add_targets(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, {"t2m": "t2m"})
    return shown(W.last_rows(panel, PANEL_SERIES, 120).select(*KEYS, "date", "t2m", F.col("t2m_d7_forecast").alias("y7")))


# --- grouped statistics on rows -------------------------------------------------------------

BY_MONTH = f"OVER (PARTITION BY {K}, month(date))"


@check(
    "a9_f11_monthly_anomaly",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, {r(f'avg(t2m) {BY_MONTH}')} AS mean, {r(f'stddev_samp(t2m) {BY_MONTH}')} AS std,
        {r(f't2m - avg(t2m) {BY_MONTH}')} AS anomaly FROM panel""", ("t2m",)),
)
def a9(spark, sf):
    panel = daily_panel(spark, sf, ("t2m",)).withColumn("month", F.month("date"))
    rows = with_group_stats(panel, PANEL_SERIES, ["month"], "t2m", "mean", "std")
    return shown(rows.select(*KEYS, "date", "mean", "std", (F.col("t2m") - F.col("mean")).alias("anomaly")))


LEVELS = {"p05": 0.05, "p50": 0.5, "p95": 0.95}


@check(
    "a10_quantiles",
    with_panel(f"SELECT {K}, " + ", ".join(f"{r(f'quantile_cont(t2m, {p})')} AS {n}" for n, p in LEVELS.items()) + f" FROM panel GROUP BY {K}", ("t2m",)),
)
def a10(spark, sf):
    return shown(exact_quantiles(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, "t2m", LEVELS))


@check(
    "a10_quantiles_of_price",
    "SELECT " + ", ".join(f"{r(f'quantile_cont(l_extendedprice, {p})')} AS {n}" for n, p in LEVELS.items()) + " FROM lineitem",
)
def a10_price(spark, sf):
    prices = table(spark, sf, "lineitem").select("l_extendedprice", F.to_date("l_shipdate").alias("date"))
    return shown(exact_quantiles(prices, Series((), "date"), "l_extendedprice", LEVELS))


@check(
    "f12_extreme_flags",
    with_panel(
        f"""SELECT {K}, strftime(date, '%Y-%m-%d') AS date, CAST(ts > p95 AS INTEGER) AS hot, CAST(ts < p05 AS INTEGER) AS cold FROM panel JOIN
        (SELECT {K}, quantile_cont(ts, 0.05) AS p05, quantile_cont(ts, 0.95) AS p95 FROM panel GROUP BY {K}) USING ({K})""", ("ts",)),
)
def f12(spark, sf):
    panel = daily_panel(spark, sf, ("ts",))
    bounds = exact_quantiles(panel, PANEL_SERIES, "ts", {"p05": 0.05, "p95": 0.95})
    rows = attach(panel, bounds, PANEL_SERIES)
    return shown(rows.select(
        *KEYS, "date", flag(F.col("ts") > F.col("p95")).alias("hot"), flag(F.col("ts") < F.col("p05")).alias("cold")
    ))


# --- sorts ----------------------------------------------------------------------------------


@check("t1_sort_by_time", with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f'])} FROM panel ORDER BY panel.date, {K}", ("t2m",)))
def t1(spark, sf):
    return shown(daily_panel(spark, sf, ("t2m",)).orderBy("date", *KEYS))


@check("t3_head_of_series", with_panel(f"SELECT {cols([*KEYS, 'date:d', 't2m:f'])} FROM idx WHERE i < 3", ("t2m",), idx=INDEXED))
def t3(spark, sf):
    return shown(W.first_rows(daily_panel(spark, sf, ("t2m",)), PANEL_SERIES, 3))
